"""Training-data operators: scoring, filtering, near duplicates, mixing, encoding."""
