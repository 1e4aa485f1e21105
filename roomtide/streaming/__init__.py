"""Structured Streaming queries: live tables, archive, heartbeat and registry."""
