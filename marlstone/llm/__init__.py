"""Operators that prepare training data: names, addresses, survivors, tokens, leaks and languages."""
