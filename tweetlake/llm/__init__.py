"""Operators for preparing training corpora at scale; their queries are in ``queries``."""
