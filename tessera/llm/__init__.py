"""Training-data operators: deduplication, scoring, tokenisation and archives of text at scale."""
