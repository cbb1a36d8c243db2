"""Relational operators over inventories."""
