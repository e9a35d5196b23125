"""Layered retail analytics as composable Spark DataFrame transformations."""
