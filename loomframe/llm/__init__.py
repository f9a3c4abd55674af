"""Text operators for training data: dedup, packing, encoding, scans, scoring, search, chat."""
