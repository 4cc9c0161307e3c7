"""Soil-survey and farmland-evaluation operators on PySpark DataFrames."""
