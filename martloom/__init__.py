"""Retail analytics over layered tables, written as lazy PySpark DataFrame builders."""
