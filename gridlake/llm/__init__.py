"""Training-data operators: deduplication, filtering, scanning, counting and packing of documents."""
