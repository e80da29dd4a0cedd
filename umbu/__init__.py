"""Medallion indicators on Spark: bronze, silver and gold tables by load date."""
