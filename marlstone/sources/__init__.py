"""Readers of bulk packages, registers and contact files."""
