"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from pickwise.functions.scores import m6, r6, rank_order
from pickwise.functions.text import tokens

__all__ = ["m6", "r6", "rank_order", "tokens"]
