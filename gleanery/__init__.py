"""Crawl-text indexing and ranked search as Spark jobs."""
