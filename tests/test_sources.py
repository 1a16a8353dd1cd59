import json

import pytest
from pyspark.sql import functions as F

from barlake.operators import normalize as nz
from barlake.operators import quality as dq
from barlake.schemas import described_schema
from barlake.sources import documents as docs
from barlake.sources import tables as tb


def document(**change):
    rows = [{"date": f"2024-01-{i:02d}", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0, "amount": 15.0} for i in (2, 3, 4)]
    doc = {
        "schema_version": 1, "code": "000001", "fetched_at": "2024-01-04T16:00:00+08:00", "trading_date": "2024-01-04", "requested_lookback": 250,
        "actual_rows": 3, "latest_date": "2024-01-04", "source": "feed", "source_errors": [], "volume_unit": "shares", "rows": rows,
    }
    doc.update(change)
    return doc


@pytest.mark.parametrize(
    "change,problem",
    [
        ({}, None), ({"extra": 1}, "schema"), ({"schema_version": 2}, "schema"), ({"rows": []}, "row_count"), ({"actual_rows": 2}, "metadata"),
        ({"code": "1"}, "metadata"), ({"fetched_at": "2024-01-04T16:00:00"}, "metadata"), ({"latest_date": "2024-01-03"}, "metadata"),
        ({"rows": document()["rows"][::-1]}, "dates"), ({"rows": [{"date": "2024-01-02"}]}, "row_shape"), ({"source": " "}, "metadata"),
    ],
)
def test_daily_documents(spark, tmp_path, change, problem):
    (tmp_path / "a.json").write_text(json.dumps(document(**change), indent=1))
    parsed = docs.read_daily_documents(spark, str(tmp_path))
    assert [r.problem for r in parsed.collect()] == [problem]
    assert docs.daily_rows(parsed).count() == (3 if problem is None else 0)


def test_documents_are_parsed_once(spark):
    """Each text meets the two parsers once, whatever rules its rows depend on."""
    bad = document(rows=[{**r, "close": None} for r in document()["rows"]])
    raw = spark.createDataFrame([("a", json.dumps(document())), ("b", "{broken"), ("c", json.dumps(bad)), ("d", None)], "name string, text string")
    parsed = docs.parse_daily_documents(raw)
    rows = docs.document_rows(parsed, "name", "problem").groupBy("name", "problem").agg(F.count("r").alias("n"))
    assert {r.name: (r.problem, r.n) for r in rows.collect()} == {"a": (None, 3), "b": ("unreadable", 0), "c": ("rows", 0), "d": ("unreadable", 0)}
    for df in (rows, docs.daily_rows(parsed)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 2


def test_csv_with_comments_and_bom(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿code,name\n# note\n000001,a\n600000,b\n", encoding="utf-8")
    df = tb.read_strings_csv(spark, str(tmp_path / "m.csv"), ["code", "name"], ["code"])
    assert sorted(tuple(r) for r in df.collect()) == [("000001", "a"), ("600000", "b")]
    with pytest.raises(ValueError):
        tb.read_strings_csv(spark, "x", ["name"], ["code"])


def test_write_run_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "2024-01-01", "r1"), (2, "2024-01-02", "r1")], "v int, trade_date string, run_id string")
    tb.write_run(a, path)
    tb.write_run(a.where("v = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_latest_pointers(spark):
    runs = spark.createDataFrame([(1, "2024-01-01", "data_ready"), (2, "2024-01-02", "data_ready_static_only"), (3, "2024-01-03", "partial")], "run_id int, generated_at string, quality_status string")
    assert {r.pointer: r.run_id for r in tb.latest_pointers(runs).collect()} == {"any": 3, "static": 2, "full": 1}


def test_described_schema():
    assert all(f.metadata.get("comment") for f in described_schema().fields) and len(described_schema().fields) == 27


def test_requests(spark):
    good = {"schema_version": 1, "request_id": "r", "codes": ["000001"], "daily": {"lookback": 60, "fields": ["ma"]}}
    cases = [good, {**good, "codes": ["000001", "000001"]}, {**good, "daily": {"lookback": 0, "fields": ["ma"]}}, {k: v for k, v in good.items() if k != "daily"}]
    raw = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "k int, text string")
    got = {r.k: r.errors for r in nz.validate_requests(raw, "2024-01-08").collect()}
    assert got == {0: [], 1: ["code_duplicate"], 2: ["daily_lookback"], 3: ["no_scope"]}


def test_freshness_uses_the_previous_open_day(spark):
    rows = spark.createDataFrame([("14:59",), ("2024-01-05 15:00:00",), ("2024-01-04 15:00:00",), (None,), ("x",)], "quote_time string")
    got = [(r.freshness, r.quote_status) for r in dq.quote_freshness(rows, "2024-01-08 09:00:00").collect()]  # a Monday before the open
    assert got == [("current", "intraday"), ("current", "historical"), ("stale", "stale"), ("unknown", "unknown"), ("unknown", "unknown")]


def test_evidence_hash_matches_sorted_json(spark):
    import hashlib

    rec = {"b": 1, "a": "x", "c": None}
    want = hashlib.sha256(json.dumps(rec, sort_keys=True).encode()).hexdigest()[:16]
    df = spark.createDataFrame([(1, "x", None)], "b int, a string, c string")
    assert dq.evidence_hash(df, ["b", "a", "c"]).collect()[0].evidence_id == want


def _one_supplier(spark, folder, k):
    """Tables with one supplier of the given key and two bars."""
    import datetime as dt

    con = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "NATION_0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, "S", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "lineitem": (
            [(i, 1, k, 1, 5.0, 10.0 + i, dt.datetime(2001, 1, 1 + i)) for i in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in con.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_snapshot_checks_hold_for_keys_of_four_digits(spark, tmp_path):
    import duckdb

    from barlake.plans import catalog

    # 1006: symbol 4301006, too long; 1003, 1009: shown without the leading zeros of 0011003 and 0001009; 6: 430006
    for k, shown in ((1003, {"011003"}), (1006, set()), (1009, {"001009"}), (6, {"430006"})):
        d = str(tmp_path / f"k{k}")
        _one_supplier(spark, d, k)
        duck = duckdb.connect()
        for t in ("region", "nation", "supplier", "lineitem"):
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
        for name in ("src_snapshot_docs", "prj_snapshot_output"):
            df = catalog.QUERIES[name](spark, d)
            cur = duck.execute(catalog.ORACLES[name])
            at = [[c[0] for c in cur.description].index(c) for c in df.columns]
            got = sorted(map(tuple, df.collect()))
            assert got == sorted(tuple(r[i] for i in at) for r in cur.fetchall())
            if name == "prj_snapshot_output":
                assert {r[0] for r in got} == shown
