"""Queries over what loads leave behind: landed JSON, versions, runs, stored failures, files.

Each writes given tables to the shared folder as a load would, and reads them back.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.functions.clean import safe_double
from payscope.operators import checks
from payscope.operators.joins import longest_prefix
from payscope.operators.mergeable import (
    co_moments,
    distinct_sketches,
    error_bound,
    estimated,
    merged,
    pearson_of,
    united,
    without_each,
)
from payscope.plans import star
from payscope.plans.star import table
from payscope.plans.star_sql import _K, _SAMPLED, _on_mart
from payscope.plans.star_sql import SQL as STAR_SQL
from payscope.session import materialize, scratch_path
from payscope.sinks.snapshots import load_snapshot, read_snapshot, versions
from payscope.sinks.tables import export_csv, read_failures, store_fused_failures, write_bucketed
from payscope.sources.ingest import Source
from payscope.sources.json_files import read_raw_documents, typed_fields
from payscope.sources.manifest import ingest_run, latest, read_manifest


def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as nested JSON, landed in one parse, and fields taken by path and type:
    present ones, absent ones, and ones of another type."""
    path = scratch_path(spark, "documents")
    shaped = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.struct("lang", "source", F.struct("n_chars", (F.col("n_chars") / 8).alias("eighth")).alias("size")).alias("meta"),
        F.array(F.col("source"), F.substring("text", 1, 20)).alias("parts"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("only some")).alias("note"),
    )
    shaped.write.json(path)
    landed = materialize(read_raw_documents(spark, path, lines=True), "landed")
    fields = {
        "doc_id": ("$.id", "bigint"),
        "lang": ("$.meta.lang", "string"),
        "n_chars": ("$.meta.size.n_chars", "int"),
        "eighth": ("$.meta.size.eighth", "double"),
        "n_chars_text": ("$.meta.size.n_chars", "string"),
        "head": ("$.parts[1]", "string"),
        "beyond": ("$.parts[2]", "string"),
        "note": ("$.note", "string"),
        "absent": ("$.meta.none.at_all", "bigint"),
        "mistyped": ("$.meta.lang", "bigint"),
        "no_list": ("$.meta.size", "array<int>"),
    }
    return typed_fields(landed, fields)


def json_typed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events, parsed once, however many paths are read."""
    parsed = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("document"))
    fields = {
        "k": ("$.k", "bigint"),
        "k_text": ("$.k", "string"),
        "k_money": ("$.k", "decimal(9,2)"),
        "absent": ("$.list[0].k", "bigint"),
        "mistyped": ("$.k", "array<string>"),
    }
    return typed_fields(parsed, fields).withColumn("k_money", F.col("k_money").cast("double"))


def snapshot_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of line items through four loads: part of them, all, one that fails on its
    rows and one without rows, while a reader of the first version is under way."""
    path = scratch_path(spark, "versions")
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity")
    load_snapshot(items.filter("l_linenumber <= 2"), path)
    reader = read_snapshot(spark, path)
    load_snapshot(items, path)
    broken = F.when(F.col("l_linenumber") < 2, F.raise_error(F.lit("broken row")).cast("double")).otherwise(F.col("l_quantity"))
    try:
        load_snapshot(items.withColumn("l_quantity", broken), path)
    except PySparkException:
        load_snapshot(items.filter("l_quantity < 0"), path, empty=False)
    seen = {"reader": reader, "current": read_snapshot(spark, path)}
    seen |= {f"version {v}": read_snapshot(spark, path, v) for v in versions(spark, path)}
    parts = [
        df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")).withColumn("seen", F.lit(name))
        for name, df in seen.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over sources made of the given tables: one that never changes, one that
    grows, one that breaks and is mended, one without rows, one that is missing at first."""
    top = scratch_path(spark, "sources")
    land, manifest = scratch_path(spark, "land"), scratch_path(spark, "runs")
    at = lambda name: f"{top}/{name}"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    put = lambda df, name, mode="overwrite": df.write.mode(mode).csv(at(name), header=True)
    sources = {n: Source(at(n), "csv", lines=True) for n in ("steady", "growing", "mended", "late")}
    sources["bare"] = Source(at("bare"), "json", lines=True)
    put(customers, "steady")
    put(orders.filter("o_orderstatus = 'O'"), "growing")
    orders.select(F.lit("a,b\n1,2,3").alias("value")).limit(1).coalesce(1).write.text(at("mended"))
    orders.select(F.lit("").alias("value")).limit(1).coalesce(1).write.text(at("bare"))
    ingest_run(spark, sources, land, manifest, "run 1")
    put(orders.filter("o_orderstatus = 'F'"), "growing", "append")
    put(orders, "mended")
    put(customers, "late")
    ingest_run(spark, sources, land, manifest, "run 2")
    ingest_run(spark, sources, land, manifest, "run 3")
    runs = read_manifest(spark, manifest)
    last = latest(runs, "loaded").select("run_id", "source", F.lit("last loaded").alias("status"), "rows")
    return runs.select("run_id", "source", "status", "rows").unionByName(last)


def fused_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of ``failure_collection`` declared per table: one scan each."""
    folder = scratch_path(spark, "audit")
    t = lambda n: table(spark, sf_dir, n)
    store_fused_failures(
        [
            (
                t("lineitem"),
                [
                    checks.repeated("unique_lineitem", "l_orderkey", "l_linenumber"),
                    checks.outside("range_quantity", "l_linenumber", 1, 9, ["l_orderkey"]),
                    checks.missing("missing_flag", "l_returnflag", ["l_orderkey"]),
                ],
            ),
            (t("events"), [checks.unlisted("values_event_type", "event_type", ["click", "view"], F.col("value") > 50)]),
            (t("orders"), [checks.RowCheck("status_orders", F.col("o_orderstatus") == "P", ("o_orderkey", "o_orderstatus"))]),
        ],
        folder,
        "run1",
    )
    found = checks.collect_failures(read_failures(spark, folder, "run1"))
    return found.select("check_name", "n_failing", F.array_join("samples", "|").alias("samples"))


def loose_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run messages for checks whose names hold each other's start, with more or less around
    them. Names come from the types and brands of parts."""
    kind = F.concat_ws("_", F.lower("p_type"), F.lit("parts_of_the_brand"), F.substring("p_brand", 7, 2))
    kinds = table(spark, sf_dir, "part").groupBy(F.replace(kind, F.lit(" "), F.lit("_")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first")
    )
    kinds = materialize(kinds, "kinds")
    names = kinds.select(F.concat(F.lit("check_"), "kind").alias("check_name"))
    said = (
        F.when(F.col("n") % 3 == 0, F.concat(F.lit("test.check_"), "kind", F.lit("_and_more")))
        .when(F.col("n") % 3 == 1, F.left(F.concat(F.lit("check_"), "kind"), F.lit(12)))
        .otherwise(F.concat(F.lit("check_"), "kind"))
    )
    messages = kinds.select(said.alias("check_name"), F.format_string("Got %d results, first %d", "n", "first").alias("message"))
    return names.join(checks.match_messages(names, messages), "check_name", "left")


def exported_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat export as one file and as several, read back."""
    mart = materialize(star.export_projection(spark, sf_dir), "export")
    columns = {c: F.col(c) for c in mart.columns}
    order = [F.desc_nulls_last("avg_payment"), F.col("entity_id")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in mart.schema)
    out = None
    for kind, single in (("one", True), ("many", False)):
        path = scratch_path(spark, "flat")
        export_csv(mart, path, columns, order, single_file=single)
        back = spark.read.schema(schema).csv(path, header=True, enforceSchema=False).withColumn("files", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


def distinct_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different parts and customers per source, by sketches stored per day's part and united;
    whether each estimate keeps to the bound."""
    sources = {
        "lineitem": table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_linenumber").alias("part")),
        "orders": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item"), F.pmod("o_orderkey", F.lit(7)).alias("part")),
        "events": table(spark, sf_dir, "events").select(F.col("event_id").alias("item"), F.length("event_type").alias("part")),
    }
    rows = None
    for name, df in sources.items():
        df = df.select(F.lit(name).alias("source"), F.col("item").cast("long"), F.col("part").cast("long"))
        rows = df if rows is None else rows.unionByName(df)
    stored = materialize(distinct_sketches(rows, ["source", "part"], "item"), "sketches")
    scopes = united(stored, ["source"]).unionByName(united(stored).withColumn("source", F.lit("ALL")))
    exact = rows.groupBy("source").agg(F.count_distinct("item").alias("n_exact")).unionByName(
        rows.agg(F.lit("ALL").alias("source"), F.count_distinct("item").alias("n_exact"))
    )
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    return (
        estimated(scopes).join(exact, "source")
        .select("source", "n_rows", "n_exact", (off <= F.col("n_exact") * error_bound()).alias("within_bound"))
    )


def prefix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the longest prefix of their number that the line items know."""
    number = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    size = F.lit(4) + F.pmod(F.col("l_partkey"), F.lit(5)).cast("int")
    prefixes = table(spark, sf_dir, "lineitem").filter("l_linenumber < 3").select(
        F.left(number("l_orderkey"), size).alias("prefix"), F.col("l_suppkey").alias("supplier")
    )
    codes = table(spark, sf_dir, "orders").select("o_orderkey", number("o_orderkey").alias("code"))
    return longest_prefix(codes, "code", prefixes, "supplier")


def stored_co_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of all events, of each kind and of all but each kind, from one stored
    state per kind; values lie near a billion."""
    events = table(spark, sf_dir, "events").select(
        "event_type", (F.col("value") + 1e9).alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y")
    )
    stored = materialize(co_moments(events, "x", "y", ["event_type"]), "moments")
    kind = F.col("event_type")
    scopes = (
        stored.withColumn("scope", F.concat(F.lit("only "), kind)).drop("event_type")
        .unionByName(without_each(stored, "event_type").withColumn("scope", F.concat(F.lit("without "), kind)).drop("event_type"))
        .unionByName(merged(stored).withColumn("scope", F.lit("all")))
    )
    return scopes.select("scope", "n", F.round(pearson_of(), 6).alias("r"))


def bucketed_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost, outcomes and spending per entity as tables with equal buckets, joined on the
    spine without a shuffle."""
    cost = star.returned_items(spark, sf_dir).groupBy(F.col("l_suppkey").alias("entity_id")).agg(
        F.sum("payment").alias("payment"), F.sum("l_quantity").alias("volume")
    )
    outcomes = star.ratings_by_entity(spark, sf_dir)
    spend = star.spend_by_entity(spark, sf_dir)
    first, *others = [write_bucketed(df, "entity_id", 8) for df in (cost, outcomes, spend)]
    for other in others:
        first = first.join(other.hint("merge"), "entity_id", "left")
    return first


def observed_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of line items through typing, a filter, a lookup that keeps them, one that
    repeats them and a write, counted in that one job."""
    counts = checks.StageCounts()
    raw = counts.through("raw", table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"))
    typed = counts.through("typed", raw.withColumn("l_quantity", safe_double(F.col("l_quantity").cast("string"))))
    kept = counts.through("kept", typed.filter("l_quantity > 10"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    found = counts.through("found", kept.join(orders, "l_orderkey", "left"))
    events = table(spark, sf_dir, "events").select((F.col("event_id") % 50).alias("l_partkey"), "event_type").filter("event_id < 100")
    repeated = counts.through("repeated", found.join(events, "l_partkey", "left"))
    materialize(repeated, "repeated")
    return counts.preserved(spark, [("raw", "typed"), ("typed", "kept"), ("kept", "found"), ("found", "repeated")])


QUERIES = {
    "observed_stages": observed_stages,
    "distinct_by_sketch": distinct_by_sketch,
    "prefix_lookup": prefix_lookup,
    "stored_co_moments": stored_co_moments,
    "bucketed_spine": bucketed_spine,
    "json_landing": json_landing,
    "json_typed_paths": json_typed_paths,
    "snapshot_time_travel": snapshot_time_travel,
    "ingest_runs": ingest_runs,
    "fused_failures": fused_failures,
    "loose_messages": loose_messages,
    "exported_files": exported_files,
}

_KINDS = "SELECT replace(concat_ws('_', lower(p_type), 'parts_of_the_brand', substr(p_brand, 7, 2)), ' ', '_') AS kind, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1"

_EVENTS = f"SELECT event_type, value + 1e9 AS x, {_K}::DOUBLE AS y FROM events"
_R = "count(*) AS n, round(CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x - 1e9, y) END, 6) AS r"

SQL = {
    "observed_stages": """
        WITH kept AS (SELECT * FROM lineitem WHERE l_quantity > 10),
        events_of AS (SELECT event_id % 50 AS l_partkey FROM events WHERE event_id < 100),
        c AS (SELECT 'raw to typed' AS "table", count(*) AS n_raw, count(*) AS n_staged FROM lineitem
          UNION ALL SELECT 'typed to kept', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM kept)
          UNION ALL SELECT 'kept to found', (SELECT count(*) FROM kept),
            (SELECT count(*) FROM kept LEFT JOIN orders ON l_orderkey = o_orderkey)
          UNION ALL SELECT 'found to repeated', (SELECT count(*) FROM kept), (SELECT count(*) FROM kept LEFT JOIN events_of USING (l_partkey)))
        SELECT *, CASE WHEN n_raw = n_staged THEN 'OK' ELSE 'MISMATCH' END AS status FROM c""",
    "distinct_by_sketch": """
        WITH rows AS (SELECT 'lineitem' AS source, l_partkey AS item FROM lineitem UNION ALL
            SELECT 'orders', o_custkey FROM orders UNION ALL SELECT 'events', event_id FROM events)
        SELECT source, count(*) AS n_rows, count(DISTINCT item) AS n_exact, true AS within_bound FROM rows GROUP BY 1
        UNION ALL SELECT 'ALL', count(*), count(DISTINCT item), true FROM rows""",
    "prefix_lookup": """
        WITH known AS (SELECT left(lpad(l_orderkey::VARCHAR, 9, '0'), (4 + l_partkey % 5)::INT) AS prefix,
              min(l_suppkey) AS supplier FROM lineitem WHERE l_linenumber < 3 GROUP BY 1),
        codes AS (SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 9, '0') AS code FROM orders),
        tried AS (SELECT o_orderkey, n, left(code, n::INT) AS prefix FROM codes, range(4, 9) AS t(n)),
        found AS (SELECT o_orderkey, arg_max(supplier, n) AS supplier FROM tried JOIN known USING (prefix) GROUP BY 1)
        SELECT o_orderkey, code, supplier FROM codes LEFT JOIN found USING (o_orderkey)""",
    "stored_co_moments": f"""
        WITH e AS ({_EVENTS}), kinds AS (SELECT DISTINCT event_type AS kind FROM e)
        SELECT 'all' AS scope, {_R} FROM e
        UNION ALL SELECT 'only ' || event_type, {_R} FROM e GROUP BY event_type
        UNION ALL SELECT 'without ' || kind, {_R} FROM kinds JOIN e ON event_type <> kind GROUP BY kind""",
    "bucketed_spine": _on_mart(
        """SELECT entity_id, payment, volume, star, urgent_mean, low_mean
        FROM (SELECT l_suppkey AS entity_id, sum(round(l_extendedprice * 100)) AS payment, sum(l_quantity) AS volume
              FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
        LEFT JOIN quality USING (entity_id)"""
    ),
    "json_landing": """
        SELECT doc_id, lang, n_chars::INT AS n_chars, n_chars / 8 AS eighth, n_chars::VARCHAR AS n_chars_text,
          substr(text, 1, 20) AS head, NULL::VARCHAR AS beyond, CASE WHEN doc_id % 3 = 0 THEN 'only some' END AS note,
          NULL::BIGINT AS absent, NULL::BIGINT AS mistyped, NULL::INT[] AS no_list FROM documents""",
    "json_typed_paths": """
        SELECT event_id, k, k::VARCHAR AS k_text, k::DOUBLE AS k_money, NULL::BIGINT AS absent, NULL::VARCHAR[] AS mistyped
        FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "snapshot_time_travel": """
        WITH part AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity
            FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1),
        whole AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
        SELECT *, 'reader' AS seen FROM part UNION ALL SELECT *, 'version 1' FROM part
        UNION ALL SELECT *, 'current' FROM whole UNION ALL SELECT *, 'version 2' FROM whole""",
    "ingest_runs": """
        WITH c AS (SELECT count(*) AS n FROM customer), o AS (
            SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS o,
              count(*) FILTER (o_orderstatus IN ('O', 'F')) AS of FROM orders)
        SELECT run_id, source, status, rows FROM (
            SELECT 'run 1' AS run_id, 'steady' AS source, 'loaded' AS status, n AS rows FROM c
            UNION ALL SELECT 'run 1', 'growing', 'loaded', o FROM o UNION ALL SELECT 'run 1', 'mended', 'failed', 0
            UNION ALL SELECT 'run 1', 'late', 'missing', 0 UNION ALL SELECT 'run 1', 'bare', 'empty', 0
            UNION ALL SELECT 'run 2', 'steady', 'unchanged', 0 UNION ALL SELECT 'run 2', 'growing', 'loaded', of FROM o
            UNION ALL SELECT 'run 2', 'mended', 'loaded', n FROM o UNION ALL SELECT 'run 2', 'late', 'loaded', n FROM c
            UNION ALL SELECT 'run 2', 'bare', 'unchanged', 0
            UNION ALL SELECT 'run 3', unnest(['steady', 'growing', 'mended', 'late', 'bare']), 'unchanged', 0
            UNION ALL SELECT 'run 1', 'steady', 'last loaded', n FROM c UNION ALL SELECT 'run 2', 'growing', 'last loaded', of FROM o
            UNION ALL SELECT 'run 2', 'mended', 'last loaded', n FROM o UNION ALL SELECT 'run 2', 'late', 'last loaded', n FROM c)""",
    "fused_failures": f"""
        WITH {_SAMPLED}
        SELECT check_name, n_failing, array_to_string(samples, '|') AS samples FROM collected""",
    "loose_messages": f"""
        WITH kinds AS ({_KINDS}), names AS (SELECT 'check_' || kind AS check_name FROM kinds),
        messages AS (SELECT CASE n % 3 WHEN 0 THEN 'test.check_' || kind || '_and_more' WHEN 1 THEN left('check_' || kind, 12)
              ELSE 'check_' || kind END AS said, 'Got ' || n || ' results, first ' || first AS message FROM kinds),
        best AS (SELECT check_name, min((check_name <> said, said, message)) AS b FROM names JOIN messages
            ON contains(said, left(check_name, 30)) OR contains(check_name, left(said, 30)) GROUP BY 1)
        SELECT check_name, b[3] AS message FROM names LEFT JOIN best USING (check_name)""",
    "exported_files": " UNION ALL ".join(
        f"SELECT *, '{files}' AS files FROM ({STAR_SQL['export_projection']})" for files in ("one", "many")
    ),
}
