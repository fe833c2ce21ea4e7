"""Exposure rating and monitoring for order items, written as Spark DataFrame jobs."""
