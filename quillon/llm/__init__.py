"""Training-data operators: deduplication, fingerprints, mixing, sharding, language id, scoring, tokenising."""
