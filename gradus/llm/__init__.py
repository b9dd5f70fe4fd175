"""Training-data operators: deduplication, packing, token files, search, scoring. Nothing outside imports this subpackage."""
