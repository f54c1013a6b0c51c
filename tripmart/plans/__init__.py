"""Composed plans: Bronze, Silver, Gold, reports, and the query registry."""
