"""Layered analytics on Spark: bronze, silver and gold tables from files and streams."""
