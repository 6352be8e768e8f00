"""Operators of a training-data pipeline: filters, near duplicates, packing, files and shards.

Nothing else in the library imports this subpackage.
"""
