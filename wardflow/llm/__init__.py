"""Training-data operators: formats, filters, deduplication, packing, encoding."""
