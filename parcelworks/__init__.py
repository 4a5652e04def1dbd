"""Residential-market analytics as composable Spark DataFrame operators."""
