"""Stored tables: which files a change touches, what readers of an old version see, and what is read."""

import datetime as dt
import io
import os
import uuid
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from haulmark.operators import changes as C
from haulmark.plans import calendar as CAL, jobs, specs as S
from haulmark.sources import exports as X, sinks, stored as ST
from haulmark.streaming.arrivals import ingest_arrivals

NOW = dt.datetime(2025, 9, 10, 8, 0)


@pytest.fixture
def db(spark):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def rows(spark, *values):
    return spark.createDataFrame([(k, dt.date.fromisoformat(d) if d else None, v) for k, d, v in values], "k int, day date, v string").withColumn(
        ST.PART, F.coalesce(F.col("day").cast("string"), F.lit("none")))


def files(spark, name):
    """Files by partition, with the time each was written."""
    got = spark.table(name).select(ST.PART, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct()
    return {r.part: (r.f, r.t) for r in got.collect()}


def values(df):
    return sorted((r.k, str(r.day), r.v) for r in df.collect())


def test_a_merge_touches_only_its_partitions(spark, db):
    name = f"{db}.t"
    schema = T.StructType.fromDDL("k int, day date, v string")
    ST.write_partitions(spark, rows(spark, (1, "2025-01-01", "a"), (2, "2025-01-02", "b"), (3, "2025-01-03", "c"), (9, None, "n")), name,
                        ["2025-01-01", "2025-01-02", "2025-01-03", "none"])
    before = files(spark, name)
    source = rows(spark, (2, "2025-01-02", "B"), (4, "2025-01-02", "d"), (5, "2025-02-01", "e")).withColumn("line", F.col("k"))
    written = ST.change_partitions(spark, name, schema, source, lambda t, s: C.upsert_overwrite(t, s, ["k", "day"], ["line"]))
    assert written == ["2025-01-02", "2025-02-01"]
    after = files(spark, name)
    assert {p: after[p] for p in ("2025-01-01", "2025-01-03", "none")} == {p: before[p] for p in ("2025-01-01", "2025-01-03", "none")}
    assert after["2025-01-02"] != before["2025-01-02"]
    assert values(spark.table(name)) == [(1, "2025-01-01", "a"), (2, "2025-01-02", "B"), (3, "2025-01-03", "c"), (4, "2025-01-02", "d"),
                                         (5, "2025-02-01", "e"), (9, "None", "n")]
    # files that nothing points at are still there for readers that began before
    assert all(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f, _ in before.values())
    assert ST.change_partitions(spark, name, schema, source.limit(0), lambda t, s: t) == []


def test_merges_read_no_other_partition(spark, db):
    name = f"{db}.t"
    ST.write_partitions(spark, rows(spark, *[(k, f"2025-01-{1 + k % 28:02d}", "x") for k in range(280)]), name, [f"2025-01-{k:02d}" for k in range(1, 29)])
    stored = ST.parts_of(spark, name, T.StructType.fromDDL("k int, day date, v string"), ["2025-01-05"])
    assert {f.split("part=")[1][:10] for f in stored.inputFiles()} == {"2025-01-05"}
    assert stored.count() == 10


def test_a_window_is_replaced_and_its_empty_days_go(spark, db):
    name = f"{db}.log"
    days = ST.days_between(dt.date(2025, 1, 1), dt.date(2025, 1, 6))
    ST.write_partitions(spark, rows(spark, *[(k, d, "old") for k, d in enumerate(days)], (99, None, "old")), name, [*days, "none"])
    before = files(spark, name)
    ST.write_partitions(spark, rows(spark, (7, "2025-01-03", "new")), name, days[1:4])
    assert values(spark.table(name)) == [(0, days[0], "old"), (4, days[4], "old"), (5, days[5], "old"), (7, days[2], "new"), (99, "None", "old")]
    after = files(spark, name)
    assert set(after) == {days[0], days[2], days[4], days[5], "none"} and all(after[d] == before[d] for d in (days[0], days[4], days[5], "none"))
    with pytest.raises(Exception, match="outside of the partitions"):
        ST.write_partitions(spark, rows(spark, (1, "2025-05-05", "x")), name, days)
    assert values(spark.table(name))[0] == (0, days[0], "old")


def test_labels_may_hold_anything(spark, db):
    name = f"{db}.labels"
    odd = ["it's 50%", "a/b", "x=1", "2025 W1", "ü\\n", "none", "{a}"]
    df = spark.createDataFrame([(k, None, p) for k, p in enumerate(odd)], "k int, day date, v string").withColumn(ST.PART, F.col("v"))
    for _ in range(2):
        ST.write_partitions(spark, df, name, odd)
        assert sorted(r.v for r in spark.table(name).where("part = v").collect()) == sorted(odd)
    assert ST.stored_parts(spark, name) == set(odd)


def test_signatures_are_looked_up_in_their_partitions(spark, db):
    name = f"{db}.signed"
    schema = T.StructType.fromDDL("k int, day date, v string, row_sig string")
    signed = lambda *v: rows(spark, *v).withColumn("row_sig", F.concat_ws("|", "day", "v"))
    history = [(k, f"2025-01-{1 + k % 28:02d}", str(k)) for k in range(56)]
    jobs.append_new(spark, name, schema, signed(*history), ["k"])
    before = files(spark, name)
    jobs.append_new(spark, name, schema, signed((100, "2025-01-01", "0"), (101, "2025-01-01", "new"), (102, "2025-01-01", "new")), ["k"])
    got = values(spark.table(name))
    assert len(got) == 57 and (101, "2025-01-01", "new") in got
    assert {p: f for p, f in files(spark, name).items() if p != "2025-01-01"} == {p: f for p, f in before.items() if p != "2025-01-01"}


def test_readers_of_an_old_version_finish(spark, db):
    name = f"{db}.weeks"
    weeks = CAL.calendar_weeks(CAL.year_span(spark, 2024, 1))
    ST.replace_table(spark, weeks, name)
    lazy = spark.table(name)
    ST.replace_table(spark, lazy.filter("week_year = 2025"), name)
    assert lazy.count() == weeks.count() and spark.table(name).count() == 52
    # what was retired goes once it has been so for long enough, and no sooner
    assert ST.purge_versions(spark, name) == 0
    assert ST.purge_versions(spark, name, dt.timedelta(0)) == 1
    assert spark.table(name).count() == 52
    with pytest.raises(Exception):
        lazy.collect()


def test_folders_of_failed_runs_go_and_those_of_other_tables_stay(spark, db):
    ST.replace_table(spark, spark.range(3), f"{db}.a")
    ST.replace_table(spark, spark.range(4), f"{db}.a_v")
    home = spark.catalog.getDatabase(db).locationUri.removeprefix("file:")
    lost = f"{home}/a_v{uuid.uuid4().hex}"
    os.makedirs(lost)
    assert ST.purge_versions(spark, f"{db}.a") == 0 and os.path.exists(lost)
    assert ST.purge_versions(spark, f"{db}.a", dt.timedelta(0)) == 1 and not os.path.exists(lost)
    assert spark.table(f"{db}.a").count() == 3 and spark.table(f"{db}.a_v").count() == 4


def test_a_lookup_reads_one_row_group(spark, db):
    name = f"{db}.people"
    people = spark.range(200_000).select(F.format_string("T%06d", (F.col("id") * 7919) % 200_000).alias("transporter_id"), F.col("id").alias("n"))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 17))
    try:
        ST.replace_table(spark, people.repartition(4), name, cluster=["transporter_id"])
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    hit = 0
    groups = 0
    for f in spark.table(name).inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        for k in range(meta.num_row_groups):
            ends = meta.row_group(k).column(0).statistics
            groups += 1
            hit += ends.min <= "T123456" <= ends.max
    assert groups > 4 and hit == 1
    assert spark.table(name).where("transporter_id = 'T123456'").count() == 1


def test_rows_written_in_order(spark, tmp_path):
    weeks = CAL.calendar_weeks(CAL.year_span(spark, 2000, 30)).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_ordered(weeks, f"{tmp_path}/weeks", ["week_year", "week_of_year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sinks.order_breaks(spark, f"{tmp_path}/weeks", ["week_year", "week_of_year"]).collect() == []
    names = sorted(f for f in os.listdir(f"{tmp_path}/weeks") if f.endswith(".parquet"))
    got = [tuple(r) for f in names for r in pq.read_table(f"{tmp_path}/weeks/{f}").select(["week_year", "week_of_year"]).to_pandas().itertuples(index=False)]
    assert len(names) > 1 and got == sorted(got) and len(got) == weeks.count()
    weeks.write.parquet(f"{tmp_path}/mixed")
    assert sinks.order_breaks(spark, f"{tmp_path}/mixed", ["week_year", "week_of_year"]).count() > 0


def test_inventory_has_files_and_times(spark, db):
    ST.replace_table(spark, spark.range(10).repartition(2), f"{db}.a")
    ST.replace_table(spark, spark.range(0), f"{db}.b")
    got = {r.table_name: r for r in sinks.file_inventory({t: spark.table(f"{db}.{t}") for t in "ab"}, "dsp").collect()}
    assert (got["a"].row_count, got["a"].files) == (10, 2) and got["a"].bytes > 0
    assert got["a"].created_utc <= got["a"].modified_utc and abs((got["a"].modified_utc - dt.datetime.now()).total_seconds()) < 86400
    assert (got["b"].row_count, got["b"].files, got["b"].created_utc) == (0, 0, None)


# --- folders and archives ----------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_headers_are_found_once_and_rows_stay_where_they_are(spark, tmp_path):
    for k in range(6):
        head = ["Transporter ID,Name,Status", 'status,"NAME", Transporter ID ', '﻿Name,"Transporter\nID"'][k % 3]
        line = [f"T{k},n{k},A", f"A,n{k},T{k}", f"n{k},T{k}"][k % 3]
        (tmp_path / f"x [{k}] {{a}}.csv").write_text(f"{head}\n{line}\n", encoding="utf-8")
    headers = X.read_headers(spark, str(tmp_path))
    assert sorted(len(h.files) for h in headers) == [2, 2, 2]
    got = X.read_table_rows(spark, str(tmp_path), S.PEOPLE)
    assert "Exchange" not in plan(got) and "Join" not in plan(got) and plan(got).count("FileScan csv") == 3
    assert sorted((r["name"], r["status"]) for r in got.collect()) == sorted((f"n{k}", None if k % 3 == 2 else "A") for k in range(6))
    assert sorted(r["transporter id"] or "" for r in got.collect()) == ["", "", "T0", "T1", "T3", "T4"]
    one = X.read_table_rows(spark, [f"{tmp_path}/x [0] {{a}}.csv"], S.PEOPLE)
    assert [r["transporter id"] for r in one.collect()] == ["T0"]


def test_many_headers_and_no_file_at_all(spark, tmp_path):
    for k in range(X.GROUPS + 4):
        (tmp_path / f"{k}.csv").write_text(f"Metric,h{k}\nm{k},{k}\n,,\nbad,1,2\n" if k % 2 else f"Metric,h{k},\nm{k},{k}\n")
    got = {(r.metric, r.label, r.cell) for r in X.read_matrix_cells(spark, str(tmp_path)).where("metric is not null").collect()}
    assert got == {(f"m{k}", f"h{k}", str(k)) for k in range(X.GROUPS + 4)}
    assert X.read_surplus_rows(spark, str(tmp_path)).count() == (X.GROUPS + 4) // 2
    rows_ = X.read_table_rows(spark, str(tmp_path), S.PEOPLE, extra=["metric", "h3"])
    assert [r["h3"] for r in rows_.where("metric = 'm3'").collect()] == ["3"]
    assert X.read_table_rows(spark, str(tmp_path), S.PEOPLE, "routes").collect() == []
    assert X.read_matrix_cells(spark, str(tmp_path), "routes").collect() == []


def test_each_member_is_a_task(spark):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(10):
            z.writestr(zipfile.ZipInfo(f"{k} Weekly Report.csv") if k % 2 else f"{k} Weekly Report.csv", "a,b\n" + "".join(f"{k},{j}\n" for j in range(k * 1000)))
        z.writestr("empty.csv", "")
        z.writestr("readme.txt", "x")
    archives = spark.createDataFrame([("/p", "n", bytearray(packed.getvalue()))], "file_path string, file_name string, content binary")
    got = X.bundle_rows(archives)
    assert got.rdd.getNumPartitions() == 11
    per = {(r.member, r.task): r["count"] for r in got.select("member", F.spark_partition_id().alias("task")).groupBy("member", "task").count().collect()}
    assert {m: n for (m, _), n in per.items()} == {f"{k} Weekly Report.csv": k * 1000 for k in range(1, 10)}
    assert len(per) == len({task for _, task in per}) == 9
    assert X.bundle_rows(archives.limit(0)).collect() == []


def test_too_long_texts_are_found_among_the_rejects(spark, db, tmp_path):
    long = "CX" + "1" * 250
    (tmp_path / "Itineraries_DSW3_2025-09-04_23-51.csv").write_text(
        f"Transporter ID,Route Code,DSP\nT1,{long},a\nT2,{long}2,{'b' * 129}\nT3,{'x' * 100},c\nT2,{long}2,{'b' * 129}\n")
    assert S.ITINERARIES.schema()["route_code"].metadata == {"max_length": 200} and S.ROUTES.schema()["route_code"].metadata == {"max_length": 32}
    for _ in range(2):
        jobs.ingest_directory(spark, str(tmp_path), db, NOW)
    assert [r.transporter_id for r in spark.table(f"{db}.itineraries").collect()] == ["T3"]
    rejected = {r.transporter_id: (r.failed, r.rows, r.route_code) for r in spark.table(f"{db}.itineraries_rejected").collect()}
    assert rejected == {"T1": (["route_code longer than 200"], 1, long),
                        "T2": (["dsp_name longer than 128", "route_code longer than 200"], 2, long + "2")}
    jobs.ingest_directory(spark, str(tmp_path), db, NOW, options={"itineraries": {"strategy": "truncate"}})
    assert {r.route_code for r in spark.table(f"{db}.itineraries").collect()} == {long[:200], "x" * 100}


def _exports(root):
    return {
        "1/Routes_DSW3_2025-09-04_14_11.csv": "Route Code,Transporter ID,Driver Name\nCX1,A|B,x|y\n",
        "1/Station_Level_Metrics_1.csv": "Date,DSP,Delivered Packages\n2025-09-01,S,5\n",
        "2/Routes_DSW3_2025-09-04_14_11.csv": "Driver Name,Route Code,Transporter ID\nlater,CX1,A\n",
        "2/DA_Tenure_Workforce_DAs_Report.csv": "Transporter ID,Name,Year,Week\nT9,New N,2025,36\n",
        "3/DA_Tenure_Workforce_DAs_Report.csv": "Transporter ID,Name,Year,Week\nT9,New N,2025,37\nbad,,,\n",
        "3/Station_Level_Metrics_1.csv": "Date,DSP,Delivered Packages\n2025-09-01,S,9\n2025-09-02,S,6\nnone,S,1\n",
    }


def test_arrivals_equal_one_run(spark, tmp_path):
    whole, checkpoint = tmp_path / "whole", str(tmp_path / "checkpoint")
    one, three = f"one_{uuid.uuid4().hex}", f"three_{uuid.uuid4().hex}"
    for name in (one, three):
        spark.sql(f"CREATE DATABASE {name}")
    for arrival in "123":
        for path, text in _exports(whole).items():
            if path.startswith(arrival):
                (whole / path).parent.mkdir(parents=True, exist_ok=True)
                (whole / path).write_text(text)
        assert ingest_arrivals(spark, str(whole), three, checkpoint, NOW) == 2
    assert ingest_arrivals(spark, str(whole), three, checkpoint, NOW) == 0
    jobs.ingest_directory(spark, str(whole), one, NOW)

    def state(name):
        return {t.name: sorted(str(r) for r in spark.table(f"{name}.{t.name}").drop(ST.PART).collect()) for t in spark.catalog.listTables(name)}

    assert state(one) == state(three) and len(state(one)["tenure_backlog_raw"]) == 3
    # a batch that is replayed under its name writes what it wrote
    again = [str(whole / p) for p in _exports(whole) if p.startswith("2")]
    jobs.ingest_directory(spark, again, three, NOW, run="exports batch 1")
    assert state(three)["tenure_backlog_raw"] == state(one)["tenure_backlog_raw"]
