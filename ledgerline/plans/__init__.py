"""Logical building blocks: the sales fact, the dirty fixture, skew-safe ranking."""
