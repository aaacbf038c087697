"""Relational operators, generic over their key columns."""
