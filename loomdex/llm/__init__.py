"""Training-data operators: filters, duplicates, decontamination, extraction, search and packing."""
