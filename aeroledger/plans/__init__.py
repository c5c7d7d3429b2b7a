"""Silver, gold and report tables."""
