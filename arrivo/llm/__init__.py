"""Operators for large text corpora: language, duplicates, mixing, tokens, sharding, filters, chat format.

Each module is one operator with its own general interface; ``queries`` holds the thin driver queries.
Nothing else in the library imports this package.
"""
