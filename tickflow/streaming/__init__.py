"""Structured Streaming forms of the operators, and the code that runs them."""
