"""Delivery and seller analytics as plain DataFrame functions on Spark."""
