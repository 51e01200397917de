"""Operators that prepare text for language models, one module each; queries.py registers them."""
