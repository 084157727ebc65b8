"""Training-data operators: quality, formatting, archives, scoring, dedup, mixing, packing, language ID."""
