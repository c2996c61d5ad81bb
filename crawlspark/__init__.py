"""crawlspark: web-crawl data processing as PySpark DataFrame jobs."""
