"""Operators of a training-data pipeline: mixing, packing, de-duplication, filters, scoring, search and output."""
