"""Structured Streaming twins of the stability monitor."""
