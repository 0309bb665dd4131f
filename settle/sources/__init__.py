"""Readers: the post log, the event fixture and the stored tables."""
