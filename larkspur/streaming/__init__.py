"""Structured Streaming twins of incremental operators."""
