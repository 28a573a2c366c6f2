"""Structured Streaming: an extension; the batch operators do not need it."""
