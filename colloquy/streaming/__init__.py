"""Streams of comments."""
