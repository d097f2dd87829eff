"""Connected components over an edge table; they are an operator that does without this folder."""

from postloom.operators.graph import components

__all__ = ["components"]
