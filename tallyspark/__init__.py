"""Listing units on Spark."""
