"""JSON scans: nested documents, saved result pages, dataset catalogs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: rows a full page holds.
PAGE_SIZE = 500

CATALOG = (
    "dataset array<struct<identifier string, "
    "distribution array<struct<downloadURL string>>>>"
)


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    *,
    lines: bool = False,
) -> DataFrame:
    """JSON documents under an explicit nested schema, so only the fields in it are
    built: one per file, or one per line of files that can then be split among tasks. A
    leading byte-order mark is skipped; invalid JSON is an error."""
    return spark.read.schema(schema).json(path, multiLine=not lines, mode="FAILFAST")


# Longest text that is kept as a VARIANT, whose binary form may be several times as long
# and has a limit of 16 MiB.
VARIANT_CHARS = 4 << 20


def read_raw_documents(
    spark: SparkSession, path: str | list[str], *, lines: bool = False
) -> DataFrame:
    """JSON documents whole, so that no field is lost: one per file, or one per line.

    Each is parsed once, here, into the VARIANT ``document``; ``typed_fields`` and
    ``parse_documents`` take fields out of it without another parse. Invalid JSON is an
    error, and so is a field that an object has twice; what follows the document's end on
    its line or in its file is not looked at. A document too long for a VARIANT
    stays text in ``oversize`` and is parsed, and found invalid, when it is staged.
    """
    text = F.regexp_replace("value", "^\ufeff", "")
    texts = spark.read.text(path, wholetext=not lines).select(text.alias("text")).filter(F.trim("text") != "")
    fits = F.length("text") <= VARIANT_CHARS
    return texts.select(
        F.when(fits, F.parse_json("text")).alias("document"), F.when(~fits, F.col("text")).alias("oversize")
    )


def parse_documents(raw: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The fields of a schema out of landed documents. Other fields are left, absent ones
    are NULL, and a value that can't be cast to its field's type is an error."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    held = F.variant_get("document", "$", fields.simpleString())
    parsed = F.when(F.col("oversize").isNull(), held).otherwise(F.from_json("oversize", schema, {"mode": "FAILFAST"}))
    return raw.select(parsed.alias("d")).select("d.*")


def typed_fields(raw: DataFrame, fields: Mapping[str, tuple[str, str]], document: str = "document") -> DataFrame:
    """Typed values by path out of a VARIANT column (name -> (path, type)), beside the other
    columns. A path that is absent, or whose value isn't of the type, is NULL."""
    taken = [F.try_variant_get(document, path, kind).alias(name) for name, (path, kind) in fields.items()]
    return raw.select(*(c for c in raw.columns if c not in (document, "oversize")), *taken)


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    *,
    page_size: int = PAGE_SIZE,
    number: str | None = None,
    lines: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Rows of saved pages ``{"results": [...]}``, every field as text.

    Every page is read; ``lines`` reads one page per line, which lets a large file be
    split among tasks. Without ``columns`` the fields are found in a first pass.

    A page with fewer than ``page_size`` rows should be the last one. ``seen`` observes,
    while the rows are read, the number of ``pages``, of ``short`` ones, and the rows of
    the last one (``last``), by the top-level field ``number`` or the last number in the
    file name; ``missing_pages`` makes a remark of it.
    """
    reader = spark.read
    if columns is not None:
        fields = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        page_type = T.StructType([T.StructField("results", T.ArrayType(fields))])
        if number is not None:
            page_type = page_type.add(number, T.StringType())
        reader = reader.schema(page_type)
    if number is None:
        order = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1)
    else:
        order = F.col(number)
    documents = reader.json(
        path, multiLine=not lines, mode="FAILFAST", primitivesAsString=True
    )
    if seen is None:
        return documents.select(F.explode("results").alias("row")).select("row.*")
    held = F.coalesce(F.size("results"), F.lit(0))
    pages = documents.select(order.try_cast("bigint").alias("page"), held.alias("held"), "results")
    watched = pages.observe(
        seen,
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("held") < page_size).alias("short"),
        F.max_by("held", "page").alias("last"),
    )
    return watched.select(F.explode("results").alias("row")).select("row.*")


def missing_pages(seen: Observation, page_size: int = PAGE_SIZE) -> str:
    """What the pages read say about pages that may be missing."""
    found = seen.get
    last = found["last"]
    short = found["short"] - (1 if last is not None and last < page_size else 0)
    return f"{short} of {found['pages']} pages are short before the last" if short > 0 else ""


def resolve_download(
    spark: SparkSession, path: str, dataset_id: str, suffix: str = ".csv"
) -> str:
    """Address of the first distribution with the suffix (any case) of the first
    catalog entry whose identifier contains the id and that has one."""
    found = resolve_downloads(spark, path, dataset_id, suffix).first()
    if found is None:
        raise LookupError(f"no {suffix} download for {dataset_id} in {path}")
    return found.downloadURL


def resolve_downloads(
    spark: SparkSession, path: str, dataset_id: str, suffix: str = ".csv"
) -> DataFrame:
    """The one row behind ``resolve_download``, empty when there is none."""
    return first_downloads(read_documents(spark, path, CATALOG), dataset_id, suffix)


def first_downloads(
    catalogs: DataFrame, dataset_id: str, suffix: str = ".csv", by: Sequence[str] = ()
) -> DataFrame:
    """Per catalog (``by`` names it) the first distribution with the suffix (any case) of
    the first entry whose identifier contains the id and that has one."""
    entries = catalogs.select(*by, F.posexplode("dataset").alias("i", "d"))
    fitting = (
        entries.filter(F.contains(F.col("d.identifier"), F.lit(dataset_id)))
        .select(*by, "i", F.posexplode("d.distribution").alias("j", "x"))
        .filter(F.endswith(F.lower(F.col("x.downloadURL")), F.lit(suffix.lower())))
    )
    if not by:
        return fitting.orderBy("i", "j").limit(1).select("x.downloadURL")
    first = F.min(F.struct("i", "j", "x.downloadURL"))
    return fitting.groupBy(*by).agg(first.alias("first")).select(*by, "first.downloadURL")
