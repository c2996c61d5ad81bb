"""Structured Streaming forms of the keyed, continuous operators."""
