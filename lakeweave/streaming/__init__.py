"""Structured Streaming forms of the pipeline steps (ST1-ST6)."""
