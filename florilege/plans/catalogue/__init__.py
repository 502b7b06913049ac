"""Queries by subject.  Each module has QUERIES: key -> (function of session and folder, SQL or None)."""
