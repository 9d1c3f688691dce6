"""Corpus scans, page adapters, admission gates, HTML tokens and output sinks."""
