"""Column expressions: text, dates, hashes, statuses, JSON."""
