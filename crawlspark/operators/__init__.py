"""DataFrame operators: HTML, robots, sitemaps, duplicates, outcomes, merges, politeness."""
