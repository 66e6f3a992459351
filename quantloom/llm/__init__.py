"""Operators for preparing language-model training data: ten numbered operators and their queries."""
