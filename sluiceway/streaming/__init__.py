"""Structured Streaming flows; each processes what is available and stops."""
