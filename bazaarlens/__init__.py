"""Marketplace analytics as DataFrame-in, DataFrame-out operators on Spark."""
