"""Operators for building language-model training corpora.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``registered`` holds the thin queries.
"""
