"""Operators for training data and entity matching. Nothing outside of this subpackage imports it."""
