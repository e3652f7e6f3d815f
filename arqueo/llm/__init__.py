"""Training-data operators: dedup, archives, language model, quality, tokens, URLs, packing."""
