"""Structured Streaming forms of the jobs that carry state across runs."""
