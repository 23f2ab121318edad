"""Operators that prepare training text: ten numbered operators and their queries."""
