"""Structured Streaming forms of the crawl jobs."""
