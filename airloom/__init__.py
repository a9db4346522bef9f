"""Hourly environmental time series on Spark: clean, engineer, store, split, fit, score, explore."""
