"""Composite plans: report rows, the A/B summary, and the named query catalog."""
