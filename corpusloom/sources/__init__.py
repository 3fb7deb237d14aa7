"""Sources: JSONL / Parquet corpora, vocabulary files, indexed datasets."""
