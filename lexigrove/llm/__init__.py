"""Operators for preparing language-model training corpora.

The rest of the library never imports this subpackage.
"""
