"""Streaming sinks and progress."""
