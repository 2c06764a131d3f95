"""Structured Streaming form of the slot monitor."""
