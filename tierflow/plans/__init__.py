"""Whole runs: conform tables, plan backfills, publish, keep the ledger."""
