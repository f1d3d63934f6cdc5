"""Training-data operators: toxicity, packing, mixing, deduplication, secrets, extraction, fingerprints."""
