"""Fact loads composed from the operators."""
