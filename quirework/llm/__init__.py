"""Operators that prepare page text and documents for training language models. Nothing outside this subpackage imports it."""
