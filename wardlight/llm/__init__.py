"""Training-data operators: deduplication, scans, packing, search and classifiers over a table of documents."""
