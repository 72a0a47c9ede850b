"""Readers: files and landed pages to typed DataFrames."""
