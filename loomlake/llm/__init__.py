"""Operators for preparing language-model training data. Nothing else in loomlake imports this subpackage."""
