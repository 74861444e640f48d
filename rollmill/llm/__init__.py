"""Training-data operators: scoring, counting, deduplication, packing, classification, scans, archives."""
