"""Operators for training data: rules, near copies, packing, classifiers, tokens, scans, search and models."""
