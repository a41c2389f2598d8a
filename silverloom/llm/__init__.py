"""Operators for building training data: near duplicates, search, classifiers, extraction, mixing, packing.

Nothing outside this package imports it. Every module holds one operator; ``queries`` registers them over the given tables.
"""
