"""Corpus operators for training data. Nothing else in the package imports this subpackage."""
