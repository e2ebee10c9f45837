import json
import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from payscope.plans import prices, star
from payscope.sinks.tables import (
    export_csv,
    read_failures,
    recent_failures,
    store_failures,
    truncate_and_load,
    write_spread,
)
from payscope.sources.archives import list_members, unpack_first_member
from payscope.sources.csv_files import read_csv
from payscope.sources.ingest import Source, ingest, read_raw
from payscope.sources import csv_files, json_files
from payscope.sources.json_files import (
    missing_pages,
    read_documents,
    read_pages,
    read_raw_documents,
    resolve_download,
    resolve_downloads,
    typed_fields,
)

PREAMBLE = 'hospital_name,last_updated_on,license\r\n"Some, Hospital",2024-01-01,"x ""y"" z"\r\n'
UNIX = PREAMBLE.replace("\r\n", "\n")
HEADER = "description,code|1,code|1|type,standard charge|gross\r\n"
BODY = (
    '"a, b",1,CPT,10\r\n'
    '"say ""hi""",2,CPT,20\r\n'
    '"two\nlines",3,CPT,30\r\n'
    "short,4\r\n"
    "\r\n"
    "café,5,N/A,nan\r\n"
)
ROWS = [
    ("a, b", "1", "CPT", "10"),
    ('say "hi"', "2", "CPT", "20"),
    ("two\nlines", "3", "CPT", "30"),
    ("short", "4", None, None),
    ("café", "5", None, None),
]


def put(path, text, encoding="utf-8"):
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def got(scan):
    return sorted((tuple(r) for r in scan.df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_preamble_csv(spark, tmp_path, encoding):
    path = put(tmp_path / "odd name%41.csv", PREAMBLE + HEADER + BODY, encoding)
    scan = read_csv(spark, path, 2)
    assert scan.fallback.count() == (encoding == "latin-1") and got(scan) == ROWS
    assert scan.df.columns == ["description", "code_1", "code_1_type", "standard_charge_gross"]
    assert {r.original: r.clean for r in scan.renames.collect()}["code|1"] == "code_1"
    assert {t for _, t in scan.df.dtypes} == {"string"}
    # Column pruning must not shift what counts as a row.
    assert scan.df.select("code_1").count() == 5


def test_plain_csv_and_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "f.csv", b"\xef\xbb\xbf" + (HEADER + BODY).encode())
    scan = read_csv(spark, path)
    assert scan.df.columns[0] == "description" and got(scan) == ROWS


def test_missing_cells_can_be_kept(spark, tmp_path):
    path = put(tmp_path / "f.csv", HEADER + BODY)
    assert got(read_csv(spark, path, missing=()))[-1] == ("café", "5", "N/A", "nan")


def test_row_longer_than_the_header_is_an_error(spark, tmp_path):
    path = put(tmp_path / "f.csv", UNIX + "a,b\n1,2\n")
    assert read_csv(spark, path, 2).df.count() == 1  # The preamble may be longer.
    path = put(tmp_path / "g.csv", UNIX + "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv(spark, path, 2).df.collect()


def test_mixed_line_ends(spark, tmp_path):
    path = put(tmp_path / "f.csv", PREAMBLE + "a,b\n1,2\n3,4\n")
    with pytest.raises(Exception, match="mixed line ends"):
        read_csv(spark, path, 2).df.collect()
    assert read_csv(spark, path, 2, multiline=False).df.count() == 2


def test_large_file_is_split_and_loses_no_row(spark, tmp_path):
    n = 200_000
    lines = "".join(f"{i},{i % 7},text {i}\n" for i in range(n))
    path = put(tmp_path / "f.csv", PREAMBLE + "id,k,t\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400000")
    try:
        scan = read_csv(spark, path, 2, multiline=False)
        assert scan.df.rdd.getNumPartitions() > 4
        assert scan.df.agg(F.count("*"), F.sum(F.col("id").cast("long"))).first()[:] == (n, n * (n - 1) // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folder_of_preamble_files(spark, tmp_path):
    for i in range(3):
        put(tmp_path / f"part{i}.csv", UNIX + "id,t\n" + "".join(f"{i}{j},x\n" for j in range(4)))
    scan = read_csv(spark, str(tmp_path), 2)
    assert sorted(r.id for r in scan.df.collect()) == sorted(f"{i}{j}" for i in range(3) for j in range(4))
    put(tmp_path / "part9.csv", UNIX + "other,t\n1,x\n")
    with pytest.raises(ValueError, match="header differs"):
        read_csv(spark, str(tmp_path), 2)


def test_encoding_is_decided_per_whole_file(spark, tmp_path):
    put(tmp_path / "f.csv", b"t\n" + "é\n".encode() * 5000 + b"\xe9\n")
    # Text that was mangled before is valid, and is left alone.
    put(tmp_path / "g.csv", "t\né\nâ€“\n")
    scan = read_csv(spark, str(tmp_path))
    assert [r.file.rsplit("/", 1)[1] for r in scan.fallback.collect()] == ["f.csv"]
    texts = {r.t: r["count"] for r in scan.df.groupBy("t").count().collect()}
    assert texts == {"Ã©": 5000, "é": 2, "â€“": 1}
    for f, t in (("f.csv", b"\xe9"), ("g.csv", "é".encode())):
        put(tmp_path / f, UNIX.encode() + b"id," + t + b"\n1," + t + b"\n")
    scan = read_csv(spark, str(tmp_path / "f.csv"), 2)
    assert scan.df.columns == ["id", "unnamed_column"] and scan.df.collect() == [("1", "é")]
    # The same header in both encodings, in one scan.
    assert read_csv(spark, str(tmp_path), 2).df.collect() == [("1", "é")] * 2


def test_headers_of_a_folder_have_to_agree(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n10,20\n")
    put(tmp_path / "b.csv", "y,x\n20,10\n")
    with pytest.raises(ValueError, match="header differs"):
        read_csv(spark, str(tmp_path))


def test_only_heads_are_read_for_headers(spark, tmp_path):
    """A quoted line break in the header, its end in bytes, and a file of megabytes of which
    one block is fetched; no line goes through Python."""
    head = UNIX + '"a\nb","c ""d"""\r\n'
    path = put(tmp_path / "odd name%41.csv", head + "1,2\n" * 1_000_000)
    fetched = []

    def read(start, n):
        fetched.append(n)
        return open(path, "rb").read()[start : start + n]

    assert csv_files.header_at(read, 2, None) == (["a\nb", 'c "d"'], len(head.encode())) and fetched == [csv_files.HEAD_BLOCK]
    found = csv_files.file_headers(spark, path, 2, "UTF-8")
    assert [(list(r.header), r.offset, r.utf8) for r in found.collect()] == [(["a\nb", 'c "d"'], len(head.encode()), True)]
    assert "mapInArrow" not in csv_files.file_validity(spark, path)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("text", "row", "want"), [
    (b"a,b", 0, (["a", "b"], 3)), (b"a,b\r1,2\r", 0, (["a", "b"], 4)), (b"\n\na\n", 0, (["a"], 4)), (b"x\n", 1, (None, 2)), (b"", 0, (None, 0)),
    (b"\xef\xbb\xbfa\n", 0, (["a"], 5)), (b"\xe9\n", 0, (["\u00e9"], 2)), (b'"a\n', 0, (None, 3)), (b"p\n" * 40 + b"h\n", 40, (["h"], 82)),
])
@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_headers_of_any_form(text, row, want, block, monkeypatch):
    monkeypatch.setattr(csv_files, "HEAD_BLOCK", block)
    assert csv_files.header_at(lambda start, n: text[start : start + n], row, None) == want


def test_file_systems_that_only_spark_knows(spark, tmp_path, monkeypatch):
    put(tmp_path / "f.csv", UNIX + "a,b\n1,2\n")
    monkeypatch.setattr(csv_files, "ARROW_SCHEMES", ())
    assert read_csv(spark, str(tmp_path), 2).df.collect() == [("1", "2")]


def test_header_far_down(spark, tmp_path):
    path = put(tmp_path / "f.csv", "".join(f"line {i}\n" for i in range(205)) + '"a\n\nb",c\n1,2\n')
    scan = read_csv(spark, path, 205)
    assert scan.df.columns == ["a_b", "c"] and scan.df.collect() == [("1", "2")]
    with pytest.raises(ValueError, match="no record"):
        read_csv(spark, path, 900)


def pages(folder, *sizes, size_name="p"):
    folder.mkdir()
    start = 0
    for i, n in enumerate(sizes):
        rows = [{"id": start + j, "v": None if j else "x"} for j in range(n)]
        (folder / f"{size_name}_{i}.json").write_text(json.dumps({"results": rows, "count": 9}))
        start += n
    return str(folder)


@pytest.mark.parametrize(
    ("sizes", "short"), [((3, 3, 1), 0), ((3, 3, 0), 0), ((3, 2, 3), 1), ((3, 3), 0), ((0, 3, 2, 1), 2)]
)
def test_all_pages_are_read_and_short_ones_reported(spark, tmp_path, sizes, short):
    seen = Observation()
    df = read_pages(spark, pages(tmp_path / "p", *sizes), ["id", "v"], page_size=3, seen=seen)
    assert df.columns == ["id", "v"] and {t for _, t in df.dtypes} == {"string"}
    assert sorted(int(r.id) for r in df.collect()) == list(range(sum(sizes)))
    said = missing_pages(seen, 3)
    assert said == (f"{short} of {len(sizes)} pages are short before the last" if short else "")


def test_raw_documents_keep_every_field(spark, tmp_path):
    whole = {**CHARGES, "extra": {"deep": [1, {"x": None}]}}
    path = put(tmp_path / "d.json", b"\xef\xbb\xbf" + json.dumps(whole, indent=1).encode())
    land = str(tmp_path / "raw")
    ingest(spark, {"doc": Source(path, "json")}, land)
    raw = read_raw(spark, land, ["doc"])["doc"]
    assert json.loads(raw.first().document.toJson()) == whole
    assert prices.stage_json_payers(raw).count() == 1 and prices.stage_json_first(raw).count() == 3
    lined = put(tmp_path / "l.json", json.dumps(whole) + "\n\n" + json.dumps({"a": 1}) + "\n")
    assert read_raw_documents(spark, lined, lines=True).count() == 2


def test_a_document_too_long_for_a_variant_stays_text(spark, tmp_path, monkeypatch):
    path = put(tmp_path / "d.json", json.dumps(CHARGES))
    usual = [tuple(r) for r in prices.stage_json_payers(read_raw_documents(spark, path)).collect()]
    monkeypatch.setattr(json_files, "VARIANT_CHARS", 10)
    raw = read_raw_documents(spark, path)
    assert raw.first().document is None and json.loads(raw.first().oversize) == CHARGES
    assert [tuple(r) for r in prices.stage_json_payers(raw).collect()] == usual and usual


def test_typed_fields_of_landed_documents(spark, tmp_path):
    rows = [{"k": 5, "s": "x", "d": {"deep": [1, 2.5]}}, {"k": "5", "s": None}, {"k": {"a": 1}, "d": []}, {}]
    path = put(tmp_path / "l.json", "\n".join(map(json.dumps, rows)))
    fields = {"k": ("$.k", "bigint"), "s": ("$.s", "string"), "second": ("$.d.deep[1]", "double"), "day": ("$.k", "array<int>"), "none": ("$.x.y", "string")}
    got = typed_fields(read_raw_documents(spark, path, lines=True).withColumn("at", F.monotonically_increasing_id()), fields).orderBy("at")
    assert [tuple(r)[1:] for r in got.collect()] == [(5, "x", 2.5, None, None), (5, None, None, None, None), (None,) * 5, (None,) * 5]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1


@pytest.mark.parametrize("text", ['{"a": 1', "{'a': 1}", '{"a": 1, "a": 2}'])
def test_broken_documents_are_errors(spark, tmp_path, text):
    path = put(tmp_path / "l.json", '{"a": 0}\n' + text + "\n")
    with pytest.raises(Exception, match="MALFORMED|DUPLICATE"):
        read_raw_documents(spark, path, lines=True).select(F.col("document").cast("string")).collect()


def test_failed_reload_keeps_the_table(spark, tmp_path):
    land = str(tmp_path / "raw")
    path = put(tmp_path / "f.csv", "a,b\n" + "1,2\n" * 50)
    assert ingest(spark, {"t": Source(path, "csv")}, land).first().status == "loaded"
    for text, status in (("a,b\n1,2\n1,2,3\n", "failed"), ("a,b\n", "empty")):
        put(tmp_path / "f.csv", text)
        assert ingest(spark, {"t": Source(path, "csv")}, land).first().status == status
        assert read_raw(spark, land, ["t"])["t"].count() == 50
    assert sorted(p.name for p in (tmp_path / "raw").iterdir()) == ["t", "t__renames"]


def test_pages_without_given_columns(spark, tmp_path):
    df = read_pages(spark, pages(tmp_path / "p", *[2] * 11, 1), page_size=2)
    # Eleven pages: the order is by number, not by text.
    assert df.count() == 23 and dict(df.dtypes)["id"] == "string"


CHARGES = {
    "hospital_name": "x",
    "standard_charge_information": [
        {
            "description": "one",
            "code_information": [{"code": "70", "type": "CPT"}, {"code": "9", "type": "RC"}],
            "standard_charges": [
                {
                    "setting": "inpatient",
                    "gross_charge": 12.5,
                    "discounted_cash": "n/a",
                    "payers_information": [
                        {"payer_name": "A", "plan_name": "P", "standard_charge_dollar": 10},
                        {"payer_name": "B", "plan_name": "Q", "methodology": "fee"},
                    ],
                },
                {"setting": "ignored", "gross_charge": 99},
            ],
        },
        {"description": "two", "standard_charges": [{"payers_information": []}]},
        {"description": "three"},
    ],
}


@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
def test_nested_documents(spark, tmp_path, rows, mark):
    path = put(tmp_path / "d.json", mark + json.dumps(CHARGES, indent=1).encode())
    raw = read_documents(spark, path, prices.DOCUMENT)
    first = prices.stage_json_first(raw)
    assert rows(first.select("code", "code_type", "description", "setting", "gross_charge", "discounted_cash_charge")) == [
        ("70", "CPT", "one", "inpatient", 12.5, None),
        (None, None, "three", None, None, None),
        (None, None, "two", None, None, None),
    ]
    assert rows(prices.stage_json_payers(raw).select("code", "payer_name", "negotiated_dollar")) == [("70", "A", 10.0)]


def test_broken_document_fails(spark, tmp_path):
    path = put(tmp_path / "d.json", json.dumps(CHARGES)[:-40])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, path, prices.DOCUMENT).collect()


CATALOG = {
    "dataset": [
        {"identifier": "http://x/other", "distribution": [{"downloadURL": "z.csv"}]},
        {"identifier": "http://x/abc-1/v2", "distribution": [{"title": "no address"}]},
        {
            "identifier": "http://x/abc-1/v1",
            "distribution": [{"downloadURL": "x.json"}, {"downloadURL": "y.CSV"}, {"downloadURL": "z.csv"}],
        },
    ]
}


def test_catalog(spark, tmp_path):
    path = put(tmp_path / "c.json", json.dumps(CATALOG))
    assert resolve_download(spark, path, "abc-1") == "y.CSV"
    assert resolve_downloads(spark, path, "nothing").count() == 0
    with pytest.raises(LookupError):
        resolve_download(spark, path, "abc-1", ".parquet")


def make_zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return str(path)


def test_zip(spark, tmp_path):
    text = PREAMBLE + HEADER + BODY
    one = make_zip(tmp_path / "one.zip", **{"a.csv": text.encode("latin-1")})
    make_zip(tmp_path / "two.zip", **{"b.csv": text, "c.csv": "x,y\n1,2\n"})
    listed = {r.path.rsplit("/", 1)[1]: r.warning for r in list_members(spark, str(tmp_path)).collect()}
    assert listed == {"one.zip": None, "two.zip": "expected 1 member, found 2"}
    for archive in (one, str(tmp_path / "two.zip")):
        scan = read_csv(spark, unpack_first_member(spark, archive), 2)
        assert scan.fallback.count() == 0 and got(scan) == ROWS


def test_long_zip_keeps_its_order(spark, tmp_path):
    text = PREAMBLE + "id\n" + "".join(f"{i}\n" for i in range(50_000))
    path = make_zip(tmp_path / "z.zip", **{"a.csv": text})
    scan = read_csv(spark, unpack_first_member(spark, path), 2)
    assert [int(r.id) for r in scan.df.collect()] == list(range(50_000))


def test_ingest(spark, tmp_path):
    land = str(tmp_path / "raw")
    sources = {
        "csv": Source(put(tmp_path / "a.csv", PREAMBLE + HEADER + BODY, "latin-1"), "csv", 2),
        "zip": Source(make_zip(tmp_path / "b.zip", **{"d.json": json.dumps(CHARGES), "e": ""}), "json_zip", schema=prices.DOCUMENT),
        "pages": Source(pages(tmp_path / "p", 3, 1), "pages", page_size=3),
        "empty": Source(pages(tmp_path / "q", 0), "pages", columns=["id"], page_size=3),
        "gone": Source(str(tmp_path / "nowhere.csv"), "csv"),
        "odd": Source(str(tmp_path / "a.csv"), "parquet9"),
        "broken": Source(put(tmp_path / "x.json", "{"), "json", schema=prices.DOCUMENT),
    }
    for _ in range(2):
        manifest = {r.source: r for r in ingest(spark, sources, land).collect()}
    status = {k: (r.status, r.rows) for k, r in manifest.items()}
    assert status == {
        "csv": ("loaded", 5), "zip": ("loaded", 1), "pages": ("loaded", 4), "empty": ("empty", 0),
        "gone": ("missing", 0), "odd": ("failed", 0), "broken": ("failed", 0),
    }
    assert "unknown kind" in manifest["odd"].message and manifest["csv"].columns == 4
    assert manifest["csv"].message.startswith("read as Latin-1") and not manifest["pages"].message
    assert manifest["zip"].message == "expected 1 member, found 2"
    raw = read_raw(spark, land, ["csv", "zip"])
    assert raw["csv"].count() == 5 and spark.table("zip").count() == 1
    assert spark.read.parquet(land + "/csv__renames").count() == 3


def test_load_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    truncate_and_load(spark.range(10), path)
    assert truncate_and_load(spark.range(3).withColumn("b", F.lit(1)), path) == {"rows": 3, "columns": 2}
    assert spark.read.parquet(path).count() == 3


def test_spread_write(spark, tmp_path):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") < 900, "hot").otherwise("cold"))
    path = str(tmp_path / "t")
    assert write_spread(df, path, "s") == {"rows": 1000, "columns": 2}
    back = spark.read.parquet(path)
    assert {r.s: r["count"] for r in back.groupBy("s").count().collect()} == {"hot": 900, "cold": 100}


@pytest.mark.parametrize("single", [True, False])
def test_export(spark, tmp_path, single):
    df = spark.createDataFrame([("b", 1.5), ("a", None), ("c", 9.0), ("d", 9.0)], "k string, v double")
    path = tmp_path / "out"
    export_csv(
        df, str(path), {"key": F.col("k"), "price": F.col("v")},
        [F.desc_nulls_last("price"), F.asc("key")], single_file=single,
    )
    files = sorted(path.glob("*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines() if line != "key,price"]
    assert lines == ["c,9.0", "d,9.0", "b,1.5", "a,"]
    assert files[0].read_text().startswith("key,price\n") and (not single or len(files) == 1)


def test_stored_failures(spark, tmp_path):
    folder = str(tmp_path / "audit")
    bad = spark.createDataFrame([("A", 2)], "k string, n int")
    store_failures({"one": bad, "two": bad.limit(0)}, folder, "run1")
    store_failures({"one": bad.union(bad)}, folder, "run2")
    store_failures({"one": bad}, folder, "run2")
    assert [r.failing_row for r in read_failures(spark, folder, "run1").collect()] == ['{"k":"A","n":2}']
    assert read_failures(spark, folder).count() == 2
    assert recent_failures(spark, folder, "2020-01-01 00:00:00").count() == 2
    assert recent_failures(spark, folder, "2999-01-01 00:00:00").count() == 0


def test_landed_documents_take_less_than_the_table_of_their_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(star, "FILE_DOCUMENTS", 1000)
    landed = star._landed_documents(spark, "/root/testdata/sf0.001")
    lines = spark.read.text(str(tmp_path / "documents")).agg(F.count("*"), F.sum(F.length("value"))).first()
    files = [p.stat().st_size for p in (tmp_path / "documents").glob("part-*")]
    assert landed.count() == lines[0] > 5000
    assert sum(files) * 5 < lines[1] and len(files) >= lines[0] // 1000  # read whole, so none is large
