"""Behavioural-commerce analytics as Spark DataFrame plans."""
