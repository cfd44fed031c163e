"""Retail sales staging, cleaning, star-schema loading and reporting on Spark DataFrames."""
