"""Inputs and result tables."""
