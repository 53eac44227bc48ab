"""Operators that prepare text for the training of language models.

Each module holds one operator with a general interface; ``queries`` applies
them to the test tables. Nothing outside this package imports it.
"""
