"""Structured Streaming counterparts of the minute, lifecycle and health operators."""
