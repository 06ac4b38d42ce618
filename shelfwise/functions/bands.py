"""Threshold banding: the ``if/elif`` ladders of the source become one CASE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(x: Column, rules: Sequence[tuple[Column | None, object]]) -> Column:
    """First matching rule wins.  ``rules`` is [(predicate, value), ...];
    a final ``(None, value)`` is the ELSE branch.  A NULL input fails every
    predicate and falls through to ELSE, like the row functions it replaces.
    """
    expr = None
    default = None
    for pred, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        if pred is None:
            default = v
            continue
        expr = F.when(pred, v) if expr is None else expr.when(pred, v)
    if expr is None:
        return default
    return expr.otherwise(default) if default is not None else expr


def fill(template: str, **cols: Column) -> Column:
    """Render a text template such as ``"Order {eoq} units."`` as a
    ``concat`` of its literal parts and the given columns (cast to string)."""
    import string
    parts = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(cols[field].cast("string"))
    return F.concat(*parts) if len(parts) > 1 else parts[0]
