"""Operators for building training data out of documents, pages and conversations.

Nothing outside this subpackage imports it.
"""
