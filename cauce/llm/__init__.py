"""Operators for preparing training corpora.  See the README's section on them."""
