"""Training-data operators: extraction, near-dedup, language, licences, media, search, shards, mixing, quality, packing."""
