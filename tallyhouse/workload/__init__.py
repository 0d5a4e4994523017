"""The operators over the given benchmark tables, and the same questions in SQL."""
