from __future__ import annotations

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from knownby.contract import inputs
from knownby.contract import queries as contract_queries
from knownby.session import little_disk, work_folder
from knownby.sources import bronze, sinks
from knownby.streaming import incremental

HEADER = "date,close,high,low,open,volume,adjClose,adjHigh,adjLow,adjOpen,adjVolume,divCash,splitFactor"
ROW = "2020-01-02T00:00:00.000Z,10,11,9,10.5,1000,5,5.5,4.5,5.25,2000,0,1"


def test_price_files(spark, tmp_path):
    (tmp_path / "US_01_ABC.csv").write_text(f"{HEADER}\n{ROW}\n2020-01-03,1,,3,4,5,6,7,8,9,10,11,12\n")
    (tmp_path / "NOSYMBOL.csv").write_text(f"{HEADER}\n{ROW}")
    names = HEADER.split(",")
    order = list(reversed(range(13)))
    (tmp_path / "P2_XYZ.csv").write_text(
        "," + ",".join(names[i] for i in order) + "\r\n0," + ",".join(ROW.split(",")[i] for i in order)
        + "\r\n")
    (tmp_path / "P3_BAD.csv").write_text(f"{HEADER}\n{ROW.replace('1000', 'oops')}\n{ROW}\n")
    (tmp_path / "P4_SHORT.csv").write_text("date,close\n2020-01-02,1\n")
    prices, quarantine = bronze.read_prices(spark, str(tmp_path))
    rows = {(r.permaTicker, r.ticker, str(r.p_date), r.close, r.high, r.adjVolume)
            for r in bronze.with_price_dates(prices).collect()}
    assert rows == {("US_01", "ABC", "2020-01-02", 10.0, 11.0, 2000.0),
                    ("US_01", "ABC", "2020-01-03", 1.0, None, 10.0),
                    ("NOSYMBOL", "Unknown", "2020-01-02", 10.0, 11.0, 2000.0),
                    ("P2", "XYZ", "2020-01-02", 10.0, 11.0, 2000.0)}
    bad = {(r.file.rsplit("/", 1)[1], r.reason) for r in quarantine.collect()}
    assert bad == {("P3_BAD.csv", "unreadable number"), ("P4_SHORT.csv", "required column missing")}


def test_price_files_are_read_as_csv(spark, tmp_path):
    (tmp_path / "P1_A.csv").write_text(f'{HEADER},note\n{ROW},"a, ""b"""\n', encoding="utf-8-sig")
    (tmp_path / "P2_B.csv").write_text(",".join(f'"{c}"' for c in HEADER.split(",")) + f"\r\n{ROW}\r\n\r\n")
    (tmp_path / "P3_C.csv").write_text(f"{HEADER}\n{ROW}\n2020-01-03,1,2\n")
    (tmp_path / "P4_D.csv").write_text(f"{HEADER}\n{ROW},7\n")
    (tmp_path / "P5_E.csv").write_text(f"{HEADER}\n{ROW.replace('2020-01-02', 'garbage')}\n")
    (tmp_path / "P6_F.csv").write_text(f'{HEADER}\n{ROW[:-1]}"1\n')
    (tmp_path / "P7_G.csv").write_text(f"{HEADER}," + ",".join(f"x{i}" for i in range(40)) + "\n")
    (tmp_path / "P8_H.csv").write_text("")
    prices, quarantine = bronze.read_prices(spark, str(tmp_path))
    rows = {(r.ticker, str(r.p_date), r.close, r.splitFactor) for r in bronze.with_price_dates(prices).collect()}
    assert rows == {("A", "2020-01-02", 10.0, 1.0), ("B", "2020-01-02", 10.0, 1.0)}
    bad = {(r.file.rsplit("/", 1)[1][:2], r.reason) for r in quarantine.collect()}
    assert bad - {("P8", "required column missing")} == {
        ("P3", "line of another length"), ("P4", "line of another length"), ("P5", "unreadable date"),
        ("P6", "line of another length"), ("P7", "too many columns or an open quote in the header")}


def test_fact_files(spark, tmp_path):
    entry = {"start": "2020-01-01", "end": "2020-03-31", "val": 5, "filed": "2020-05-01", "fp": "Q1",
             "accn": "a-1", "form": "10-Q"}
    good = {"cik": 320193, "entityName": "x", "facts": {
        "us-gaap": {"Revenues": {"label": "r", "units": {"USD": [entry], "CAD": [entry]}},
                    "Unlisted": {"units": {"USD": [entry]}}},
        "dei": {"EntityCommonStockSharesOutstanding": {"units": {"shares": [entry]}}}}}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps(good)[:-5])
    (tmp_path / "c.json").write_text(json.dumps({"cik": 1, "facts": {}}))
    entries, bad = bronze.read_facts(spark, str(tmp_path))
    rows = entries.orderBy("unit").collect()
    assert [(r.cik, r.sec_tag, r.unit, str(r.start_date), str(r.filed_date), r.fp, r.val, r.accession)
            for r in rows] == [
        ("0000320193", "Revenues", "CAD", "2020-01-01", "2020-05-01", "Q1", 5.0, "a-1"),
        ("0000320193", "Revenues", "USD", "2020-01-01", "2020-05-01", "Q1", 5.0, "a-1")]
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["b.json"]


def test_bootstrap_from_a_json_array(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps([{"permaTicker": "P1", "ticker": "A"},
                                                    {"permaTicker": "P2", "ticker": "B"}]))
    rows = bronze.bootstrap_registry(spark, str(tmp_path), "2024-01-01").orderBy("ticker").collect()
    assert [(r.permaTicker, r.status_prices, r.last_update, r.bootstrap_date) for r in rows] == [
        ("P1", "pending", None, "2024-01-01"), ("P2", "pending", None, "2024-01-01")]


def test_stored_matrix_prunes_years(spark):
    stored = inputs.matrix(spark, "/root/testdata/sf0.001")
    plan = stored.where("p_year = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_year" in plan
    narrow = stored.select("ticker").where("ticker = 'T1'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ticker,T1)" in narrow and "ReadSchema: struct<ticker:string>" in narrow


def test_json_records_keep_nulls(spark):
    df = spark.sql("SELECT 'a' AS x, CAST(NULL AS DOUBLE) AS y")
    assert sinks.as_json_records(df).first().record == '{"x":"a","y":null}'


def test_ingest_is_idempotent(spark):
    bars = inputs.prices(spark, "/root/testdata/sf0.001").select("permaTicker", "p_date", "close")
    landing, target = work_folder(spark, "landing"), work_folder(spark, "target")
    bars.write.parquet(landing)
    for attempt in range(2):  # a second run without its checkpoint replays the same batch ids
        incremental.ingest_prices(spark, landing, bars.schema, target=target,
                                  checkpoint=work_folder(spark, f"offsets{attempt}"))
    got = incremental.read_increments(spark, target, bars.schema).select(*bars.columns)
    assert got.exceptAll(bars).count() == 0 and bars.exceptAll(got).count() == 0


def test_exports(spark):
    m = inputs.matrix(spark, "/root/testdata/sf0.001")
    extract = sinks.research_extract(m, columns=["ticker", "pe_ratio"], min_adv=1.0)
    assert extract.columns == ["permaTicker", "ticker", "p_date", "pe_ratio"]
    assert extract.count() == m.where(F.col("adv_20d") >= 1).count()


def _packed(spark, files):
    path = work_folder(spark, "pack")
    bronze.pack(spark.createDataFrame(files, "file string, line string"), path, HEADER)
    return path


def test_packed_price_files_read_like_loose_ones(spark, tmp_path):
    files = {"US_01_ABC.csv": [ROW, ROW.replace("2020-01-02", "2020-01-03")], "P2_X.csv": [ROW.replace("1000", "oops"), ROW],
             "P3_Y.csv": [ROW + ",7"], "P4_Z.csv": [f'{ROW[:-1]}"1', ROW], "P5_Q.csv": [ROW.replace("2020-01-02", "none")]}
    (tmp_path / "loose").mkdir()
    for name, lines in files.items():
        (tmp_path / "loose" / name).write_text("\n".join([HEADER, *lines]))
    loose = bronze.read_prices(spark, str(tmp_path / "loose"))
    packed = bronze.read_prices(spark, _packed(spark, [(n, x) for n, lines in files.items() for x in lines]), packed=True)
    assert packed[0].count() == 2 and sorted(packed[0].collect()) == sorted(loose[0].collect())
    reasons = [{(r.file.rsplit("/", 1)[-1], r.reason) for r in bad.collect()} for _, bad in (loose, packed)]
    assert reasons[0] == reasons[1] and len(reasons[0]) == 4


def test_packs_hold_many_files_in_few(spark):
    path = _packed(spark, [(f"P{i}_T.csv", ROW) for i in range(500)])
    assert len(spark.read.schema("file string").json(path).inputFiles()) <= 4
    assert bronze.read_prices(spark, path, packed=True)[0].select("permaTicker").distinct().count() == 500


def _bar_tables(path):
    """Three securities, one of them listed twice, one bar repeated and one without a security."""
    def put(name, columns):
        pq.write_table(pa.table(columns), path / f"{name}.parquet")

    key = [1, 1, 1, 2, 2, 7, None, 9]
    day = [dt.datetime(2020, 1, d) for d in (2, 2, 3, 2, 3, 2, 2, 2)]
    put("lineitem", {"l_suppkey": pa.array(key, pa.int64()), "l_shipdate": pa.array(day, pa.timestamp("us")),
                     "l_extendedprice": [10.0, 10.0, 12.0, 9.0, None, 3.0, 4.0, 5.0], "l_quantity": [2.0] * 8,
                     "l_discount": [0.5] * 8, "l_tax": [0.0, 0.08, 0.0, 0.0, 0.0, 0.08, 0.0, 0.0], "l_returnflag": ["A"] * 8})
    put("supplier", {"s_suppkey": pa.array([1, 2, 7, 7, None], pa.int64()), "s_nationkey": pa.array([0] * 5, pa.int32())})
    put("nation", {"n_nationkey": pa.array([0], pa.int32()), "n_regionkey": pa.array([0], pa.int32()), "n_name": ["N"]})
    put("region", {"r_regionkey": pa.array([0], pa.int32()), "r_name": ["R"]})
    return str(path)


def test_price_landing_takes_little_disk(spark, tmp_path, monkeypatch):
    tables, landing = _bar_tables(tmp_path), work_folder(spark, "landing")
    plans, files = [], bronze.packed_files

    def planned(*args):
        packed = files(*args)
        plans.append(packed._jdf.queryExecution().executedPlan().toString())
        return packed

    monkeypatch.setattr(bronze, "packed_files", planned)
    small = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")  # as for large tables
    try:
        contract_queries._land_prices(spark, tables, landing)
    finally:
        spark.conf.set(small, before)
    assert plans[0].count("Exchange hashpartitioning(") == 9  # two folds, two for their join, five for the listings; no lines
    assert all(f.endswith(".json.gz") for f in spark.read.text(landing).inputFiles())
    prices, bad = bronze.read_prices(spark, landing, packed=True, verdicts=work_folder(spark, "verdicts"))
    got = sorted((r.permaTicker, r.ticker, r.date[:10], r.close, r.splitFactor) for r in prices.collect())
    assert got == sorted([("P000001", "T1", "2020-01-02", 5.0, 2.0), ("P000001", "T1", "2020-01-03", 6.0, 1.0),
                          ("P000002", "T2", "2020-01-02", 4.5, 1.0), ("P000002", "T2", "2020-01-03", None, 1.0),
                          *[("P000007", "T7-P", "2020-01-02", 1.5, 2.0)] * 2])
    assert bad.count() == 0


def test_few_spoilt_files_leave_the_others_where_they_are(spark):
    path = _packed(spark, [(f"P{i}_T.csv", ROW.replace("1000", "oops") if i == 3 else ROW) for i in range(50)])
    lazy, bad = bronze.read_prices(spark, path, packed=True)
    stored, found = bronze.read_prices(spark, path, packed=True, verdicts=work_folder(spark, "verdicts"))
    assert sorted(stored.collect()) == sorted(lazy.collect()) and stored.count() == 49
    assert [(r.file, r.reason) for r in found.collect()] == [(r.file, r.reason) for r in bad.collect()]
    assert "hashpartitioning" not in stored._jdf.queryExecution().executedPlan().toString()


def test_landing_settings_are_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with little_disk(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


def test_packed_documents(spark):
    path = work_folder(spark, "pack")
    bronze.pack(spark.createDataFrame([("cik=1", '{"cik":"1","sic":"100"}'), ("cik=2", '{"cik":"2"')],
                                      "file string, line string"), path)
    good, bad = bronze.read_profiles(spark, path, packed=True)
    assert [r.cik for r in good.collect()] == ["0000000001"] and [r.file for r in bad.collect()] == ["cik=2"]


def test_plain_and_quoted_lines_give_the_same_cells(spark):
    line = " a,, b ,1.5,"
    quoted = ",".join(f'"{c}"' if c else "" for c in line.split(","))
    df = spark.createDataFrame([(line, quoted)], "plain string, quoted string")
    plain, read = df.select(bronze._cells(F.col("plain"), 8), bronze._cells(F.col("quoted"), 8)).first()
    assert [c or "" for c in plain] == [c or "" for c in read[:6]] and read[6:] == [None, None]


def test_the_document_is_cut_into_lines_once(spark, tmp_path):
    (tmp_path / "P1_A.csv").write_text(f"{HEADER}\n{ROW}\n")
    plan = bronze.read_prices(spark, str(tmp_path))[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") <= 2  # one of each pass, none in a filter or a header


def test_a_landing_grows_by_files_not_by_their_size(spark):
    rows = spark.range(4000).selectExpr("id", "DATE'1998-01-01' + CAST(id % 2 AS INT) AS day")
    path = work_folder(spark, "landing")
    contract_queries._land_twice(rows, "day", path, landed_rows=1000)
    landed = spark.read.parquet(path)
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 8000 and len(sizes) == 8 and max(sizes) <= 2000


def test_a_landed_file_is_read_by_many_tasks(spark):
    rows = spark.range(20000).selectExpr("uuid() AS id", "DATE'1998-01-01' + CAST(id % 90 AS INT) AS day")
    path = work_folder(spark, "landing")
    contract_queries._land_twice(rows, "day", path, group_bytes=64 << 10)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in spark.read.parquet(path).inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40000 and len(files) == 4
    assert min(m.num_row_groups for m in files) >= 4 and max(g.num_rows for g in groups) <= 5000
    spans = [(g.column(1).statistics.min, g.column(1).statistics.max) for g in groups]
    assert all((last - first).days < 15 for first, last in spans)  # days in order: repeats mostly meet in a task
