"""Training-data operators: deduplication, decontamination, scoring, tokenising, archives and sharding."""
