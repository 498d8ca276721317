"""Structured Streaming variants of the daily models."""
