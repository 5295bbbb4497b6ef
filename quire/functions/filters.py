"""Metadata filter compiler.

A filter is the retrieval service's dict tree, e.g.
``{"andAll": [{"greaterThan": {"key": "created_date_epoch", "value": 1}},
{"startsWith": {"key": "title", "value": "Th"}}]}``. It compiles to one
Column predicate without functions around its columns, so Catalyst pushes it
into the Parquet scan and it runs *before* any ranking. It is NULL where a key
is NULL, which ``where`` drops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LEAF = {
    "equals": lambda c, v: c == F.lit(v),
    "notEquals": lambda c, v: c != F.lit(v),
    "greaterThan": lambda c, v: c > F.lit(v),
    "greaterThanOrEquals": lambda c, v: c >= F.lit(v),
    "lessThan": lambda c, v: c < F.lit(v),
    "lessThanOrEquals": lambda c, v: c <= F.lit(v),
    "startsWith": lambda c, v: c.startswith(F.lit(v)),
    "in": lambda c, v: c.isin(list(v)),
}


def compile_filter(f: dict | None) -> Column:
    """dict tree -> Column. ``None`` means no filter (TRUE)."""
    if f is None:
        return F.lit(True)
    if not isinstance(f, dict) or len(f) != 1:
        raise ValueError(f"filter must be a single-key dict, got {f!r}")
    (op, arg), = f.items()
    if op in ("andAll", "orAll"):
        if not arg:
            raise ValueError(f"{op} needs at least one operand")
        parts = [compile_filter(x) for x in arg]
        return reduce((lambda a, b: a & b) if op == "andAll" else (lambda a, b: a | b), parts)
    if op not in _LEAF:
        raise ValueError(f"unknown filter operator {op!r}")
    if not isinstance(arg, dict) or "key" not in arg or "value" not in arg:
        raise ValueError(f"{op} needs key and value")
    return _LEAF[op](F.col(arg["key"]), arg["value"])


def exposure_filter(value: str | None) -> Column:
    """The app's exposure switch; 'None'/None turns it off."""
    if value is None or value == "None":
        return F.lit(True)
    if value not in ("external", "internal"):
        raise ValueError(f"exposure must be external or internal, got {value!r}")
    return compile_filter({"equals": {"key": "exposure", "value": value}})
