"""Operators for training-data pipelines: private data, mixing, toxicity, token files, and more."""
