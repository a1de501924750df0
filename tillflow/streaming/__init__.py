"""Structured Streaming intake of arriving feed files."""
