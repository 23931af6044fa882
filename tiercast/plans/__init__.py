"""Whole tiers and the cascade, each one plan."""
