"""Incremental landing of messages."""
