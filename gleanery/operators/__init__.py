"""Jobs over tables: index, search, crawl frontier, word jobs and metrics."""
