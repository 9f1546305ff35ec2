"""Structured Streaming forms of the operators (readStream → stateful ops → sink)."""
