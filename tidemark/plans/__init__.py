"""Finished analyses on school, shop and activity tables, and their registry."""
