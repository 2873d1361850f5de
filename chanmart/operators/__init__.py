"""Operators: ingest, lake rules, enrichment, reports, data checks."""

from chanmart.operators import checks, enrich, ingest, lake_rules, reports

__all__ = ["checks", "enrich", "ingest", "lake_rules", "reports"]
