"""Composed plans: the two profiles, the warehouse load and the daily run."""
