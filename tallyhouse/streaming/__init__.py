"""Sales enrichment for files that arrive one by one. The plans have no streaming state."""
