"""Retail price analytics on Spark: landing, cleaning, mapping, history, alerts."""
