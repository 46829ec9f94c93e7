"""Retail demand and supply analysis written as Spark DataFrame jobs."""
