"""One strict schema over differing inputs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(
    df: DataFrame, contract: T.StructType, fold: Mapping[str, str] | None = None
) -> DataFrame:
    """Exactly the contract's columns, in order. ``fold`` takes a contract column from
    another input column; what the input lacks becomes a typed NULL. A column of
    another type is an error, not a silent cast."""
    have = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in contract:
        source = (fold or {}).get(field.name, field.name)
        if source not in have:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[source] != field.dataType:
            raise TypeError(
                f"{source}: {have[source].simpleString()}, "
                f"contract wants {field.dataType.simpleString()}"
            )
        else:
            columns.append(F.col(source).alias(field.name))
    return df.select(columns)


def contract_union(
    inputs: Mapping[str, DataFrame],
    contract: T.StructType,
    label: str,
    folds: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """UNION ALL of conformed inputs, each labelled with its name. Bag semantics."""
    parts = [
        conform(df.withColumn(label, F.lit(name)), contract, (folds or {}).get(name))
        for name, df in inputs.items()
    ]
    out = reduce(DataFrame.union, parts)
    got = [(f.name, f.dataType) for f in out.schema]
    if got != [(f.name, f.dataType) for f in contract]:
        raise TypeError(f"union does not meet its contract: {out.schema.simpleString()}")
    return out
