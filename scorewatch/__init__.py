"""Cleaning, scoring and watching tabular records on Spark."""
