"""Corpus preparation for language-model training, built on Spark DataFrames.

Nothing outside this subpackage imports it, and it imports nothing from the
rest of the library, so it can be removed as a whole.
"""
