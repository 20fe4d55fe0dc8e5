"""Reference answers: one SQL text per registered query, over the test tables."""

from oracle.texts import TEXTS

__all__ = ["TEXTS"]
