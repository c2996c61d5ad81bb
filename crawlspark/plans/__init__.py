"""Crawl-wide jobs: one wave, and discovery to a fixpoint."""
