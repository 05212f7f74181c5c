"""Names of columns and tables.

Column names are derived in tasks, once for each distinct header, since there may be any number of them;
table names on the driver from the few type ids.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Last name parts that say too little on their own, and prefixes cut from ids.
AMBIGUOUS_LAST_PARTS = ("time", "value", "type", "id")
ID_PREFIXES = ("com.samsung.shealth.", "com.samsung.health.")
#: columns every table has
OWN_COLUMNS = ("user_id", "export_ts")


def _short(name: str) -> str:
    parts = name.split(".")
    return "_".join(parts[-2:]) if parts[-1] in AMBIGUOUS_LAST_PARTS else parts[-1]


def names_of(header: list[str | None], taken: tuple[str, ...] = OWN_COLUMNS) -> list[str]:
    """Column names of a header: ``a.b.heart_rate.start_time`` to ``start_time``, ``a.b.time`` to ``b_time``; blank names
    at the end are left out, and repeats get the suffix ``_2``, ``_3`` … Spark compares names without case, so do we."""
    names = [(c or "").strip(" ") for c in header]
    while names and not names[-1]:
        names.pop()
    seen = Counter(taken)
    found = []
    for name in map(_short, names):
        seen[name.lower()] += 1
        times = seen[name.lower()]
        found.append(name if times == 1 else f"{name}_{times}")
    return found


@F.pandas_udf(T.ArrayType(T.StringType()))
def header_names(header: pd.Series) -> pd.Series:
    """``names_of`` each header; to be asked once for each distinct header, not for each row."""
    return header.map(lambda cells: None if cells is None else names_of(list(cells)))


def table_name(datatype_id: str | None) -> str:
    name = datatype_id or ""
    for prefix in ID_PREFIXES:
        name = name.replace(prefix, "")
    return re.sub("[^0-9a-zA-Z]+", "_", name).strip("_").lower() or "unknown"
