"""Training-data operators: scoring, near-duplicate removal, mixing, packing and formatting of text corpora."""
