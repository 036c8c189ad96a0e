"""Structured Streaming forms of scoring, rates, account counts and drift."""
