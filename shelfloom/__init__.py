"""Captured web pages to product tables, on Spark.

Requests become a URL frontier, captured pages become product rows, and both
are kept up to date with set-based DataFrame jobs.
"""

from shelfloom.rules import SITES, PageRule, Selector, SiteRule, site_rules

__all__ = ["SITES", "PageRule", "Selector", "SiteRule", "site_rules"]
