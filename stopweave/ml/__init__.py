"""Regression models over the leg tables, on Spark ML."""
