"""Structured Streaming jobs. Each gives the same result as its batch form."""
