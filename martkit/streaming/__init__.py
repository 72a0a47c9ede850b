"""Incremental loads: window lists, window loads, micro-batches."""
