"""Training-data operators: tokens, search, formatting, extraction, filters, packing."""
