"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` applies them to the
supplied tables with production parameters. Nothing outside this package imports it.
"""
