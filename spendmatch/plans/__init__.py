"""Composed plans: the certified-spend marts and the query registry."""
