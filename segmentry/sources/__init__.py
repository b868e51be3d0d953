"""Readers and writers. Readers return lazy DataFrames with explicit schemas."""
