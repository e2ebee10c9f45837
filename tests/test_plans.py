import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from payscope.plans import analysis, build, hospital, prices
from payscope.sources.ingest import ingest

CORE = list(hospital.CORE_MEASURES.values())


def strings(spark, columns, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


def layout_columns(layout):
    return list(dict.fromkeys(c for c, _, _ in layout.columns))


def raw_rows(layout, records):
    columns = layout_columns(layout)
    return columns, [tuple(r.get(c) for c in columns) for r in records]


@pytest.fixture(scope="module")
def records():
    """Raw records of four tables for 60 hospitals in two states, some of them missing
    from a table, with every placeholder."""
    rng = random.Random(11)
    inpatient, readmissions, survey, complications = [], [], [], []
    for i in range(60):
        ccn, state = f"33{i:04}", "NY" if i % 10 else "NJ"
        zip_code = rng.choice(["10016", "10591", "12208", "11213", None])
        if i % 13:
            for d in range(rng.randint(1, 6)):
                inpatient.append({
                    "Rndrng_Prvdr_CCN": ccn, "Rndrng_Prvdr_Org_Name": f"Hospital {i}",
                    "Rndrng_Prvdr_City": "City", "Rndrng_Prvdr_State_Abrvtn": state,
                    "Rndrng_Prvdr_Zip5": zip_code, "DRG_Cd": str(d // 2),
                    "Tot_Dschrgs": rng.choice(["0", "N/A", str(rng.randint(100, 400))]),
                    "Avg_Tot_Pymt_Amt": rng.choice([None, "x", f"{rng.randint(500000, 3000000) / 100}"]),
                    "Avg_Mdcr_Pymt_Amt": f"{rng.randint(5000, 9000)}",
                })
        if i % 7:
            for m in [*CORE, "READM-30-AMI-HRRP"]:
                readmissions.append({
                    "facility_id": ccn, "facility_name": f"HOSPITAL {i}", "state": state, "measure_name": m,
                    "excess_readmission_ratio": rng.choice(
                        ["N/A", " ", None, "Too Few To Report"] + [f"{rng.uniform(0.8, 1.2):.4f}"] * 20
                    ),
                    "footnote": rng.choice(["", " 5 "]), "start_date": "07/01/2021",
                })
        if i % 5:
            for m in ("H_STAR_RATING", "H_COMP_1"):
                survey.append({
                    "facility_id": ccn, "facility_name": f"HOSPITAL {i}", "state": state,
                    "hcahps_measure_id": m,
                    "patient_survey_star_rating": rng.choice(["Not Applicable", "1", "2", "3", "4", "5"]),
                })
        for m in ("PSI_90", "MORT_30_PN", "OTHER"):
            complications.append({
                "facility_id": ccn, "state": state, "measure_id": m,
                "score": rng.choice(["Not Available", "0.5", "1.25"]),
            })
    return {
        "medicare_inpatient_utilization": (hospital.INPATIENT, inpatient),
        "hospital_readmissions": (hospital.READMISSIONS, readmissions),
        "hospital_hcahps": (hospital.SURVEY, survey),
        "hospital_complications": (hospital.COMPLICATIONS, complications),
    }


@pytest.fixture(scope="module")
def raw(spark, records, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    tables = {}
    for name, (layout, data) in records.items():
        strings(spark, *raw_rows(layout, data)).write.parquet(str(folder / name))
        tables[name] = spark.read.parquet(str(folder / name))
    return tables


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def brute_mart(records):
    """The mart by hand."""
    cost, readm, star, outcome = (defaultdict(list) for _ in range(4))
    for r in records["medicare_inpatient_utilization"][1]:
        v, w = number(r["Avg_Tot_Pymt_Amt"]), number(r["Tot_Dschrgs"])
        if r["Rndrng_Prvdr_State_Abrvtn"] == "NY" and v is not None and w is not None and w > 0:
            cost[r["Rndrng_Prvdr_CCN"]].append((v, w, r["DRG_Cd"]))
    for r in records["hospital_readmissions"][1]:
        v = number(r["excess_readmission_ratio"])
        if r["state"] == "NY" and v is not None:
            readm[r["facility_id"]].append((r["measure_name"], v))
    for r in records["hospital_hcahps"][1]:
        v = number(r["patient_survey_star_rating"])
        if r["state"] == "NY" and r["hcahps_measure_id"] == "H_STAR_RATING" and v is not None:
            star[r["facility_id"]].append(int(v))
    for r in records["hospital_complications"][1]:
        if r["state"] == "NY" and r["measure_id"] == "PSI_90" and number(r["score"]) is not None:
            outcome[r["facility_id"]].append(number(r["score"]))
    mart = {}
    for ccn, rows in cost.items():
        weight = sum(w for _, w, _ in rows)
        ratios = readm.get(ccn)
        mart[ccn] = (
            pytest.approx(sum(v * w for v, w, _ in rows) / weight, abs=0.006),
            weight,
            len({d for _, _, d in rows}),
            pytest.approx(sum(v for _, v in ratios) / len(ratios), abs=6e-5) if ratios else None,
            sum(m in CORE for m, _ in ratios) == 3 if ratios else None,
            max(star[ccn]) if ccn in star else None,
            outcome[ccn][0] if ccn in outcome else None,
        )
    return mart


def test_mart(spark, raw, records):
    mart = hospital.mart_from_raw(raw)
    assert len(mart.columns) == 18
    got = {
        r.ccn: tuple(r)[1:]
        for r in mart.select(
            "ccn", "volume_weighted_avg_payment", "total_discharges", "n_drgs",
            "avg_excess_readmission_ratio", "has_core_readmissions", "hcahps_summary_star",
            "patient_safety_psi90",
        ).collect()
    }
    want = brute_mart(records)
    assert got == want
    flags = {v[4] for v in want.values()}
    assert flags == {True, False, None}


def test_mart_does_not_depend_on_partitions(spark, raw, rows):
    spread = {n: t.repartition(7) for n, t in raw.items()}
    assert rows(hospital.mart_from_raw(spread)) == rows(hospital.mart_from_raw(raw))


def test_staging_keeps_rows_and_pushes_the_state_filter(spark, raw):
    for name, layout in (
        ("hospital_readmissions", hospital.READMISSIONS),
        ("hospital_hcahps", hospital.SURVEY),
        ("hospital_complications", hospital.COMPLICATIONS),
        ("medicare_inpatient_utilization", hospital.INPATIENT),
    ):
        assert hospital.stage(raw[name], layout).count() == raw[name].count()
    cost = hospital.cost_by_hospital(hospital.stage(raw["medicare_inpatient_utilization"], hospital.INPATIENT))
    plan = cost._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Rndrng_Prvdr_State_Abrvtn,NY)" in plan
    assert "DRG_Desc" not in plan and "SubmtdCvrd" not in plan


def test_named_models(spark, raw):
    readmissions = hospital.stage(raw["hospital_readmissions"], hospital.READMISSIONS)
    named = hospital.readmissions_by_hospital(readmissions)
    assert named.filter("hospital_name IS NULL").count() == 0
    quality = hospital.quality_by_hospital(
        hospital.stage(raw["hospital_hcahps"], hospital.SURVEY),
        hospital.stage(raw["hospital_complications"], hospital.COMPLICATIONS),
    )
    assert quality.count() == quality.select("ccn").distinct().count() > 40


def test_date_formats(spark, raw):
    plain = hospital.stage(raw["hospital_readmissions"], hospital.READMISSIONS)
    assert plain.filter("measure_start_date IS NOT NULL").count() == 0
    read = hospital.stage(raw["hospital_readmissions"], hospital.READMISSIONS, ["MM/dd/yyyy"])
    assert read.filter("measure_start_date = DATE '2021-07-01'").count() == read.count()


def price_files(folder):
    """Eight small price files in their layouts."""
    top = "hospital_name,updated\nx,2024\n"
    tall = (
        "description,code|1,code|1|type,billing_class,setting,payer_name,plan_name,"
        "standard_charge|gross,standard_charge|discounted_cash,standard_charge|negotiated_dollar,"
        "standard_charge|negotiated_percentage,standard_charge|negotiated_algorithm,"
        "standard_charge|methodology\n"
        "scan,70,CPT,fac,out,Aetna,PPO,100,90,80,,,fee\n"
        "scan,71,CPT,fac,out,Aetna,PPO,100,,,,74% of BC,other\n"
        "scan,72,CPT,fac,out,Aetna,PPO,N/A,,,,,\n"
    )
    plans = ["Aetna|PPO", "Cigna|POS 10/46"]
    header = [f"standard_charge|{p}|{s}" for p in plans for s in prices.GROUP_SUFFIXES]
    wide = ",".join(["description,code|1,code|1|type,setting,standard_charge|gross", *header])
    wide += "\nscan,70,CPT,in,5,1,,,fee,,,,\nscan,71,CPT,in,5,,,,fee,,50,,\nscan,72,CPT,in,5,,,,,,,nan,\n"
    charge = {
        "description": "scan",
        "code_information": [{"code": "70", "type": "CPT"}],
        "standard_charges": [
            {"gross_charge": 7, "payers_information": [
                {"payer_name": "A", "plan_name": "P", "standard_charge_dollar": 3},
                {"payer_name": "B", "plan_name": "P"}]}
        ],
    }
    document = json.dumps({"standard_charge_information": [charge, {"description": "bare"}]})
    import zipfile

    for source, (layout, _, _, name) in prices.HOSPITALS.items():
        text = {"tall": top + tall, "wide": top + wide}.get(layout, document)
        if source == "montefiore":
            text = text.replace(",billing_class", "").replace(",fac", "")
        if name.endswith(".zip"):
            with zipfile.ZipFile(folder / name, "w") as z:
                z.writestr("member", text)
        else:
            (folder / name).write_text(text)


def test_build_with_prices(spark, raw, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    price_files(files)
    manifest = ingest(spark, prices.raw_sources(str(files)), str(tmp_path / "land"))
    assert {r.status for r in manifest.collect()} == {"loaded"}
    landed = {n: spark.read.parquet(f"{tmp_path}/land/price_tx_{n}") for n in prices.HOSPITALS}
    everything = {**raw, **{f"price_tx_{n}": t for n, t in landed.items()}}

    result = build.build(spark, everything, str(tmp_path / "out"), "run1", include_price=True)
    assert result.counts["mart"]["rows"] == result.mart.count()
    assert result.failures.count() == 0
    # Three tall rows each, two of the wide ones survive, two charges, one payer.
    assert {r.source_hospital: r["count"] for r in result.prices.groupBy("source_hospital").count().collect()} == {
        "rochester_general": 3, "montefiore": 3, "brooklyn_hospital": 2, "flushing_hospital": 2,
        "albany_medical": 2, "nyu_langone": 2, "mount_sinai": 2, "newyork_presbyterian": 1,
    }
    assert [f.name for f in result.prices.schema] == [f.name for f in prices.CONTRACT]
    nyu = result.prices.filter("source_hospital = 'nyu_langone'").orderBy("code").collect()
    assert [(r.ccn, r.plan_name, r.payer_name, r.negotiated_dollar) for r in nyu] == [
        ("330214", "Aetna_PPO", None, 1.0), ("330214", "Cigna_POS_10_46", None, None),
    ]
    dimension = prices.hospital_dimension(spark)
    joined = result.prices.join(dimension, ["source_hospital", "ccn", "hospital_name"], "left_anti")
    assert joined.count() == 0

    # Off by default.
    assert build.build(spark, raw, str(tmp_path / "plain"), "run1").prices is None


def test_broken_mart_is_caught(spark, raw):
    mart = hospital.mart_from_raw(raw)
    broken = mart.withColumn("avg_excess_readmission_ratio", F.lit(7.0)).union(mart.limit(1))
    staged = [
        hospital.stage(raw["hospital_readmissions"], hospital.READMISSIONS),
        hospital.stage(raw["hospital_hcahps"], hospital.SURVEY),
        hospital.stage(raw["medicare_inpatient_utilization"], hospital.INPATIENT),
    ]
    found = hospital.model_checks(*staged, broken)
    assert len(found) == 13
    failing = {n: c for n, c in ((n, df.count()) for n, df in found.items()) if c}
    assert failing == {"range_mart_ratio": mart.count(), "unique_mart_ccn": 1}


def test_reports(spark, raw, tmp_path):
    mart = hospital.mart_from_raw(raw)
    mart.write.parquet(str(tmp_path / "mart"))
    mart = spark.read.parquet(str(tmp_path / "mart"))
    tables = {n: t.collect() for n, t in build.analyse(mart).items()}
    counts = tables["analytic_counts"][0]
    assert counts.n_rows == mart.count() and counts.n_kept + counts.n_excluded == counts.n_rows
    assert sum(r.n for r in tables["quadrant_counts"]) == counts.n_kept
    assert sum(r.n for r in tables["robustness_group_medians"]) == counts.n_kept
    assert {r.threshold for r in tables["volume_thresholds"]} == set(analysis.THRESHOLDS)
    assert all(-1 <= r.r <= 1 and 0 <= r.p <= 1 for r in tables["robustness_correlations"])
    listed = [r.volume_weighted_avg_payment for r in tables["best_value"]]
    assert listed == sorted(listed)
    out = build.export(mart, str(tmp_path / "csv"))
    assert out.columns == [*hospital.EXPORT, "is_analytic"]
    assert out.filter("is_analytic").count() == counts.n_kept
