"""Training-data operators: cleaning, de-duplication, scoring, packing, archives and sharding of text corpora."""
