"""Queries: operators composed over tables, with their SQL where SQL can state them."""
