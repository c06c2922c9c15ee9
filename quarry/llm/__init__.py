"""Training-data operators: scoring, deduplication, token storage, decontamination."""
