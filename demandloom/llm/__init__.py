"""Operators that prepare text for training language models.

Each module holds one operator with its own interface; ``queries`` derives the
registered results from them. Nothing outside this package imports it.
"""
