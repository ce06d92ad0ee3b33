"""Tidemark: reusable analytics over Spark DataFrames."""
