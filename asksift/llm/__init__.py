"""Operators that prepare training text: mixing, fingerprints, extraction,
joins, scans, archives, quality, duplicates, contamination."""
