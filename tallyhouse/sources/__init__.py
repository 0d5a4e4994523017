"""Readers that keep the file order as a column, and sinks that never write over their input."""
