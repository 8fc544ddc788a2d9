"""Structured Streaming form of the sync (landing files -> Bronze)."""
