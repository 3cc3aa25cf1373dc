"""Clickstream and ad-click metrics as Spark DataFrame transformations."""
