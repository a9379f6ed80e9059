"""Quarterly trip features on Spark: publish, land, clean, enrich, aggregate, store."""
