"""Training-data operators: scoring, extraction, deduplication, mixing and sharding of text corpora."""
