"""The batch operators run incrementally."""
