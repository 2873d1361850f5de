"""Column-level building blocks (JSON fields, dates, text)."""

from chanmart.functions import dates, json_fields, text

__all__ = ["dates", "json_fields", "text"]
