"""Record-enrichment analytics as PySpark DataFrame operators."""
