"""Scans of files and topics, and the matching batch writes."""
