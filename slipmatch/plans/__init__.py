"""Operators put together: the reconciliation and the daily run."""
