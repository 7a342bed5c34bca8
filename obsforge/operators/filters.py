"""The dashboards' filter language: ``{column} op value && {column} op value``.

Operators: ge le lt gt ne eq contains.  Values of eq and ne may be comma lists
(any of them, none of them) and may hold ``*`` (LIKE).  The result is a column
expression, so the optimizer folds it and pushes it into the scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = re.compile(r"^\s*\{(?P<col>[^}]+)\}\s*(?P<op>s?(?:>=|<=|<|>|!=|=)|ge|le|lt|gt|ne|eq|contains)\s*(?P<value>.*?)\s*$")
SYMBOLS = {">=": "ge", "<=": "le", "<": "lt", ">": "gt", "!=": "ne", "=": "eq"}


def _one(col: Column, value: str) -> Column:
    value = value.strip().strip("\"'")
    return col.cast("string").like(value.replace("*", "%")) if "*" in value else col == F.lit(value)


def parse(text: str) -> Column:
    terms = []
    for part in filter(str.strip, text.split("&&")):
        m = PART.match(part)
        if not m:
            raise ValueError(f"not a filter: {part!r}")
        col, value = F.col(m["col"]), m["value"].strip().strip("\"'")
        op = SYMBOLS.get(m["op"].lstrip("s"), m["op"].lstrip("s") if m["op"] not in SYMBOLS else m["op"])
        if op == "eq":
            terms.append(reduce(Column.__or__, [_one(col, v) for v in m["value"].split(",")]))
        elif op == "ne":
            terms.append(reduce(Column.__and__, [~_one(col, v) for v in m["value"].split(",")]))
        elif op == "contains":
            terms.append(col.cast("string").contains(value))
        else:
            terms.append({"ge": col >= value, "le": col <= value, "lt": col < value, "gt": col > value}[op])
    return reduce(Column.__and__, terms, F.lit(True))


def apply(df: DataFrame, text: str) -> DataFrame:
    return df.where(parse(text))


def angle_near(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two angles in degrees differ by less than ``tolerance`` around the circle."""
    return (F.abs(a - b) < tolerance) | (F.abs(a - b) > 360 - tolerance)
