"""Structured Streaming forms. Each must equal its batch operator on the same rows."""
