"""Operators of a training-data pipeline: near-duplicates, quality, mixing, packing and scoring.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
