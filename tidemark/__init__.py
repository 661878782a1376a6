"""Vintage time-series analytics on Spark."""
