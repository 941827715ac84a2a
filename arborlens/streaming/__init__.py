"""Streaming forms of operators."""
