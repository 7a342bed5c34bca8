"""References to records that do not exist.

A reference is a tuple of columns that names a row of a target table.  Partly
null tuples are grouped by their null mask, and each mask is anti-joined on the
columns which it has, under the declared match semantics:

* ``simple``: a tuple with any null refers to nothing and is no orphan;
* ``partial``: the non-null columns must occur together in some target row;
* ``full``: a tuple must be wholly null or wholly non-null; a mixed one is an orphan.

A wholly null tuple is never an orphan.  Target rows with null keys match only
on the columns they have.  When a record arrives plays no part: a key that
comes later than its reference is there.  An empty target makes every non-null
reference an orphan; an empty source gives no rows; repeated rows give one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(refs: DataFrame, target: DataFrame, ref_cols: Sequence[str], key_cols: Sequence[str], match: str = "simple") -> DataFrame:
    """The rows of ``refs`` whose reference finds no target row."""
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"match must be simple, partial or full, not {match}")
    keys = target.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key_cols)])
    found = []
    for mask in product((True, False), repeat=len(ref_cols)):
        if not any(mask):
            continue
        rows = refs.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() if m else F.col(c).isNull() for c, m in zip(ref_cols, mask)]))
        if not all(mask) and match != "partial":
            if match == "full":
                found.append(rows)
            continue
        own = [i for i, m in enumerate(mask) if m]
        there = keys.select(*[f"_k{i}" for i in own]).dropna().distinct()
        found.append(rows.join(there, [F.col(ref_cols[i]) == F.col(f"_k{i}") for i in own], "left_anti"))
    return reduce(DataFrame.unionByName, found)
