"""Queries made of operators."""
