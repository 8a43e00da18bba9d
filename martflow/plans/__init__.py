"""Warehouse datasets: staging views, dimensions, facts and scores.

Each module states the column layout of its source as a data dictionary and
builds the dataset from the general operators.
"""
