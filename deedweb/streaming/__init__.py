"""Incremental resolution of addresses with Structured Streaming."""
