"""Wide to long, and nested to flat."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.clean import any_present, first_of


@dataclass(frozen=True)
class ColumnGroups:
    """What ``discover_groups`` found in a header.

    ``groups``      label -> one column per suffix, in suffix order
    ``incomplete``  labels that lack a suffix and the columns they have; not melted
    ``ignored``     columns with the prefix that end in none of the suffixes
    """

    suffixes: tuple[str, ...]
    groups: Mapping[str, tuple[str, ...]]
    incomplete: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ignored: tuple[str, ...] = field(default=())


def discover_groups(
    columns: Sequence[str],
    prefix: str,
    suffixes: Sequence[str],
    originals: Mapping[str, str] | None = None,
    separator: str = "|",
) -> ColumnGroups:
    """Columns named ``<prefix><label>_<suffix>`` grouped by label; only labels with
    every suffix can be melted. Reads names only, so it costs no job.

    Two headers that are alike once cleaned differ by a number at the end of the second
    name (``.._suffix_1``), which goes into the label. ``originals`` (clean name ->
    header) groups by the header up to its last ``separator`` instead, which is right
    also where one of the two lacks a suffix.
    """
    form = re.compile("(.+)_(" + "|".join(map(re.escape, suffixes)) + r")(_\d+)?", re.DOTALL)
    found: dict[tuple[str, str], dict[str, str]] = {}
    ignored = []
    for column in columns:
        if not column.startswith(prefix):
            continue
        match = form.fullmatch(column, len(prefix))
        if not match:
            ignored.append(column)
            continue
        label, suffix, number = match.groups()
        if originals is None:
            key = (label + (number or ""), "")
        else:
            key = (label, originals.get(column, column).rpartition(separator)[0])
        if suffix in found.setdefault(key, {}):
            ignored.append(column)
        else:
            found[key][suffix] = column
    taken: set[str] = set()
    labels: dict[str, dict[str, str]] = {}
    for (label, _), members in found.items():
        name, n = label, 0
        while name in taken:
            n += 1
            name = f"{label}_{n}"
        taken.add(name)
        labels[name] = members
    complete = {
        label: tuple(members[s] for s in suffixes)
        for label, members in sorted(labels.items())
        if len(members) == len(suffixes)
    }
    if not complete:
        raise ValueError(f"no complete group {prefix}*_{{{','.join(suffixes)}}}")
    return ColumnGroups(
        tuple(suffixes),
        complete,
        {k: tuple(m.values()) for k, m in sorted(labels.items()) if k not in complete},
        tuple(ignored),
    )


def dropped_groups(df: DataFrame, groups: ColumnGroups) -> DataFrame:
    """What is not melted, one row per column: label, column, reason, and the number of
    cells with a value, all counted in one pass."""
    lost = [(label, c, "incomplete group") for label, cs in groups.incomplete.items() for c in cs]
    lost += [(None, c, "no known suffix") for c in groups.ignored]
    if not lost:
        return df.sparkSession.createDataFrame([], "label string, column string, reason string, n_cells bigint")
    counted = df.agg(*(F.count(_quoted(c)).alias(f"n{i}") for i, (_, c, _) in enumerate(lost)))
    rows = [
        F.struct(F.lit(label).cast("string").alias("label"), F.lit(c).alias("column"), F.lit(why).alias("reason"), F.col(f"n{i}").alias("n_cells"))
        for i, (label, c, why) in enumerate(lost)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def melt_groups(
    df: DataFrame, ids: Sequence[str], groups: ColumnGroups, label: str
) -> DataFrame:
    """One row per input row and group with at least one measure present.

    One scan feeds one generator, whatever the number of groups; a union of one select
    per group would scan the file once per group. ``stack`` made the rows of 413 groups
    four times as fast as the UNPIVOT clause did. Ids absent from the input are skipped.
    """
    ids = [_quoted(c) for c in ids if c in df.columns]
    cells: list[Column] = []
    for name, members in groups.groups.items():
        cells += [F.lit(name), *(F.col(_quoted(c)) for c in members)]
    rows = F.stack(F.lit(len(groups.groups)), *cells).alias(label, *groups.suffixes)
    return keep_any_present(df.select(*ids, rows), groups.suffixes)


def keep_any_present(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows with at least one of the measures."""
    return df.filter(any_present(*(F.col(_quoted(m)) for m in measures)))


def explode_records(
    df: DataFrame, records: Column, fields: Mapping[str, Column], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per element of an array, as named expressions over the element (column
    ``record``). A NULL or empty array gives no row."""
    return df.select(*keep, F.explode(records).alias("record")).select(
        *keep, *(c.alias(n) for n, c in fields.items())
    )


def explode_nested(
    df: DataFrame,
    records: Column,
    outer: Mapping[str, Column],
    inner: Column,
    fields: Mapping[str, Column],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per element of an array inside each element of an array.

    ``outer`` and ``inner`` are expressions over ``record``, ``fields`` over ``item``.
    The outer scalars are projected before the second explode, so the parent record is
    not copied once per inner element.
    """
    parents = explode_records(df, records, {**outer, "_items": inner}, keep)
    return parents.select(*keep, *outer, F.explode("_items").alias("item")).select(
        *keep, *outer, *(c.alias(n) for n, c in fields.items())
    )


def first_element(array: Column, *path: str) -> Column:
    """A field of the first element of an array; NULL when there is none."""
    out = first_of(array)
    for name in path:
        out = out.getField(name)
    return out


def recover_parts(
    df: DataFrame,
    label: str,
    renames: DataFrame,
    prefix: str,
    suffix: str,
    parts: Sequence[str],
    separator: str = "|",
) -> DataFrame:
    """Split the melted label back into the parts its original header had.

    ``renames`` is the map a scan kept of (original, clean) header names; a header reads
    ``prefix|part|part|suffix``. One row per group, so it is broadcast.
    """
    pieces = F.split("original", "\\" + separator)
    form = f"^{prefix}(.+)_{suffix}(_[0-9]+)?$"
    lookup = renames.filter(F.col("clean").rlike(form)).select(
        F.regexp_replace("clean", form, "$1$2").alias(label),
        *(F.trim(F.get(pieces, F.lit(i + 1))).alias(p) for i, p in enumerate(parts)),
    )
    return df.drop(*parts).join(F.broadcast(lookup), label, "left")
