"""Structured Streaming forms of landing, reporting, scoring and velocity."""
