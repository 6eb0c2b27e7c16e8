"""Structured Streaming jobs. Each writes through the idempotent merge of its table."""
