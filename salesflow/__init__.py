"""Incremental sales loading, star-schema upkeep and order clustering on Spark."""
