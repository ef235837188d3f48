"""Operators of a training-data pipeline: one module each, and ``entries`` with their queries."""
