"""Operators for building language-model training data: each module is one operator, `queries` registers them."""
