"""The registry that ``__spark_entry__`` serves: queries by name, and the SQL of those that SQL can express."""

from tideglass.plans import choices, facts, intake, pages, records, relations, scalars, sites, texts
from tideglass.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "choices", "facts", "intake", "pages", "records", "relations", "scalars", "sites", "texts"]
