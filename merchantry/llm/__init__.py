"""Operators on text corpora for training data; nothing else in the library needs them."""
