"""Training-data operators: near-duplicate joins, scans, classifiers, tokenization."""
