"""Column names that any table format takes, with the map back to the header."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the naming rule.
LONGEST_NAME = 300
EMPTY_NAME = "unnamed_column"
DIGIT_PREFIX = "col_"


def clean_name(header: str) -> str:
    """Runs of anything but ASCII letters, digits and ``_`` become one ``_``."""
    words = [w for w in re.split(r"[^0-9A-Za-z]+", header) if w]
    name = "_".join(words) or EMPTY_NAME
    return (DIGIT_PREFIX + name if name[0].isdigit() else name)[:LONGEST_NAME]


def clean_names(headers: Sequence[str]) -> list[str]:
    """Clean names, in header order, unique without regard to case. A repeated name
    takes the first free ``_1``, ``_2``, .. and stays within the length limit."""
    taken: set[str] = set()
    last: dict[str, int] = {}
    out = []
    for header in headers:
        base = name = clean_name(header)
        count = last.get(base.lower(), 0)
        while name.lower() in taken:
            count += 1
            tail = f"_{count}"
            name = base[: LONGEST_NAME - len(tail)] + tail
        last[base.lower()] = count
        taken.add(name.lower())
        out.append(name)
    return out


def rename_map(
    spark: SparkSession, headers: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """One row per column whose name changed: position, original, clean."""
    rows = [(i, o, c) for i, (o, c) in enumerate(zip(headers, names, strict=True)) if o != c]
    return spark.createDataFrame(rows, "position int, original string, clean string")


def sanitize_columns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The frame under clean names, and the rename map."""
    names = clean_names(df.columns)
    return df.toDF(*names), rename_map(df.sparkSession, df.columns, names)
