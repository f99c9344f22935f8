"""Scans: raw telemetry, layered datasets, lookup text files, declared schemas."""
