"""Streaming forms of the time-bin operators."""
