"""Dataflow operators: pure functions from a ``Tables`` value to a DataFrame."""
