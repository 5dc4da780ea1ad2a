"""Structured Streaming entry point."""
