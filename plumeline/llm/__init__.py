"""Operators for training data of language models: packing, output, filters, search, mixing."""
