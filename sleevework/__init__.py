"""Catalogue analytics on Spark: page extraction, notes mining, quality comparison, crawl audits."""
