"""Operators that prepare training text, one per module, and their queries."""
