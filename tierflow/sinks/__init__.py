"""Writers: partition replacement, keyed upsert, append."""
