"""Training-data operators: sharding, packing, dedup, language, extraction, mixing."""
