"""The operators composed into the flows that run end to end."""
