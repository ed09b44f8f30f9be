"""Operators of a pipeline for training data."""
