"""Operators against plain Python on small data, with hot keys."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, Window, functions as F

from haulmark import functions as H
from haulmark.operators import changes as C, checks as K, ranking as RK, reshape as RS
from haulmark.plans import calendar as CAL, scorecard as SC


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """4,000 rows of which a third share one key and one day."""
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", rng.randrange(6), i)
            for i in range(4000)]
    return spark.createDataFrame(data, "k string, day int, line int").repartition(7)


def test_slice_ordinal_equals_row_number(hot):
    got = RK.slice_ordinal(
        hot, ["k"], {"__day": F.col("day"), "__block": F.floor(F.col("line") / 50)},
        [F.col("line")], "n", "total")
    by_key = Window.partitionBy("k")
    want = hot.withColumn("n", F.row_number().over(by_key.orderBy("day", "line"))).withColumn(
        "total", F.count("*").over(by_key))
    assert rows(got.select("k", "day", "line", "n", "total")) == rows(want)


def test_slice_dense_rank_equals_dense_rank(hot):
    df = hot.select("k", (F.col("line") % 97).alias("v"), "line")
    want = df.withColumn("rank", F.dense_rank().over(Window.partitionBy("k").orderBy(F.desc("v"))))
    got = RK.slice_dense_rank(df, ["k"], "v", 10)
    assert rows(got.select("k", "v", "line", "rank")) == rows(want)


def test_newest_and_oldest(hot):
    data = hot.collect()
    want = {}
    for r in data:
        want.setdefault(r.k, []).append((r.day, r.line))
    assert rows(C.dedup_keep_last(hot, ["k"], ["day", "line"])) == sorted(
        ((k, *max(v)) for k, v in want.items()), key=str)
    assert rows(C.dedup_keep_first(hot, ["k"], ["day", "line"])) == sorted(
        ((k, *min(v)) for k, v in want.items()), key=str)


def test_upserts_are_repeatable(spark, hot):
    target = spark.createDataFrame([("hot", 9, -1), ("old", 1, 2)], "k string, day int, line int")
    once = C.upsert_overwrite(target, hot, ["k"], ["line"])
    assert rows(C.upsert_overwrite(once, hot, ["k"], ["line"])) == rows(once)
    assert once.groupBy("k").count().filter("count > 1").count() == 0
    assert once.filter("k = 'old'").first().line == 2


def test_coalesce_applies_rows_in_order(spark):
    target = spark.createDataFrame([("k1", "z", "z")], "k string, a string, b string")
    source = spark.createDataFrame(
        [("k1", "a", None, 1), ("k1", None, "b", 2), ("k2", "n", None, 3)],
        "k string, a string, b string, line int")
    merged = C.upsert_coalesce(target, source, ["k"], ["line"], "a")
    assert rows(merged) == [("k1", "a", "b"), ("k2", "n", None)]


def test_overwrite_keeps_nulls_and_matches_null_keys(spark):
    target = spark.createDataFrame([("A ", None, "x"), ("b", "r", "y")], "k string, n string, v string")
    source = spark.createDataFrame([(" a", None, None, 1)], "k string, n string, v string, line int")
    got = C.upsert_overwrite(target, source, ["k", "n"], ["line"], ["n"],
                             {"k": H.canonical_key(F.col("k"))})
    assert rows(got) == [("A ", None, None), ("b", "r", "y")]


def test_null_in_a_required_key_fails(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([(None, 2, 1)], "k string, v int, line int")
    with pytest.raises(PySparkException, match="null in key column k"):
        C.upsert_overwrite(target, source, ["k"], ["line"]).collect()


def test_insert_ignore_dups(spark, hot):
    signed = C.with_signature(hot, [H.key_text(F.col("k")), H.id_text(F.col("day"))])
    stored = signed.filter("k = 'hot' AND day < 3")
    got = C.insert_ignore_dups(stored, signed, "row_sig", ["line"])
    want = {}
    for r in hot.collect():
        if not (r.k == "hot" and r.day < 3):
            want[(r.k, r.day)] = min(want.get((r.k, r.day), r.line), r.line)
    assert rows(got.select("k", "day", "line")) == sorted(((*k, v) for k, v in want.items()), key=str)


def test_helper_numbers_run_over_the_file(spark):
    df = spark.createDataFrame(
        [(1, "CX1", "A|B|C", "x|y"), (2, "CX2", None, None), (3, "CX1", "D|E", "x|y")],
        "line int, route_code string, transporter_id string, driver_name string"
    ).withColumn("file", F.lit("f"))
    out = RS.helper_suffix(RS.explode_participants(df), ["file"], ["line"], block=2)
    got = {(r.line, r.participant_index): (r.route_code, r.transporter_id, r.driver_name) for r in out.collect()}
    assert got == {
        (1, 0): ("CX1", "A", "x"), (1, 1): ("CX1(1)", "B", "y"), (1, 2): ("CX1(2)", "C", None),
        (2, 0): ("CX2", None, None), (3, 0): ("CX1", "D", "x"), (3, 1): ("CX1(3)", "E", "y")}


def test_helper_tags(spark):
    df = spark.createDataFrame(
        [("f", 1, 0, "a"), ("f", 2, 1, "a"), ("f", 3, 1, "b"), ("f", 4, 2, "b"), ("f", 5, 1, "b"),
         ("f", 6, 1, "c"), ("f", 7, 0, "c"), ("f", 8, 0, "c"), ("f", 9, 1, None), ("g", 10, 1, "a")],
        "file string, line int, participant_index int, driver_name string")
    got = {r.line: r.helper_tag for r in RS.classify_helpers(df, ["file"]).collect()}
    assert got == {1: None, 2: "Rescue", 3: "Sweeper", 4: "Sweeper", 5: "Sweeper", 6: None, 7: None,
                   8: None, 9: None, 10: "Sweeper"}


def test_pivot_and_unpivot_are_inverse(spark):
    wide = spark.createDataFrame([("m1", 1.0, None), ("m2", 3.0, 4.5)], "k string, `2025-01-01` double, `2025-01-02` double")
    long = RS.unpivot_daily(wide).withColumn("day", F.col("metric_date").cast("string"))
    back = RS.metrics_wide(long, ["metric_name"], {"2025-01-01": "2025-01-01", "2025-01-02": "2025-01-02"}, "day")
    assert rows(back) == rows(wide)


def test_dropped_rows_are_counted(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (None, None), (2, "b")], "k int, n string")
    seen = Observation("dropped")
    assert rows(K.drop_null_keys(df, ["k", "n"], seen)) == [(2, "b")]
    assert seen.get == {"dropped_k": 2, "dropped_n": 1}


def test_calendar_golden_weeks(spark):
    span = CAL.year_span(spark, 2024, 2)
    weeks = {(r.week_year, r.week_of_year): (str(r.week_start), str(r.week_end))
             for r in CAL.calendar_weeks(span).collect()}
    assert weeks[2025, 1] == ("2024-12-29", "2025-01-04")
    counts = {r.week_year: r.weeks_in_year for r in CAL.weeks_per_year(CAL.calendar_weeks(span)).collect()}
    assert set(counts) == {2024, 2025, 2026} and set(counts.values()) <= {52, 53}
    days = {str(r.date): (r.week_year, r.week_of_year, r.day_name) for r in CAL.calendar_days(span).collect()}
    assert days["2024-12-28"] == (2024, 52, "Saturday") and days["2024-12-29"] == (2025, 1, "Sunday")
    assert len(days) == 366 + 365 + 365


def _metrics(spark, changed=None):
    best = {"DCR": "100", "POD": "99", "TENURED": "95"}
    values = {r[0]: best.get(r[0], "0") for r in SC.POLICY_ROWS} | (changed or {})
    return spark.createDataFrame(list(values.items()), "metric_code string, v string").select(
        F.lit("u").alias("unit"), "metric_code", F.col("v").cast("decimal(18,4)").alias("metric_value"))


@pytest.mark.parametrize("changed,flags,want", [
    (None, None, 100.0), ({"PSB": None}, None, None), ({"SPD_RATE": "9"}, None, 93.7),
    ({"PSB": None}, (1, 1), 0.0), (None, (0, 0), 0.0), (None, (0, 1), 100.0)])
def test_projected_score(spark, changed, flags, want):
    known = flags and spark.createDataFrame([("u", *flags)], "unit string, breach_of_contract int, cas_compliant int")
    got = SC.projected_score(_metrics(spark, changed), SC.policy(spark), ["unit"], known).first()
    value = got.projected_overall_score_pct
    assert (None if value is None else float(value)) == want


def test_inactive_metrics_add_points_but_no_weight(spark):
    rules = SC.policy(spark).withColumn("is_active", F.col("metric_code") != "PSB")
    as_written = SC.projected_score(_metrics(spark), rules, ["unit"]).first()[1]
    only = SC.projected_score(_metrics(spark), rules, ["unit"], active_only=True).first()[1]
    assert float(as_written) == 105.01 and float(only) == 100.0


def test_null_keys_slices_and_values_are_numbered(spark):
    data = [("a", 1, 5), ("a", None, 6), ("a", None, 7), (None, 1, 8), (None, 1, 9), ("a", 2, 1)]
    df = spark.createDataFrame(data, "k string, day int, line int")
    got = RK.slice_ordinal(df, ["k"], {"__day": F.col("day"), "__block": F.floor(F.col("line") / 2)}, [F.col("line")], "n", "total")
    got = got.select("k", "day", "line", "n", "total")
    assert rows(got) == sorted([("a", None, 6, 1, 4), ("a", None, 7, 2, 4), ("a", 1, 5, 3, 4), ("a", 2, 1, 4, 4),
                                (None, 1, 8, 1, 2), (None, 1, 9, 2, 2)], key=str)
    values = spark.createDataFrame([("a", 3.0), ("a", None), ("a", 9.0), (None, 4.0), (None, None), ("a", 3.0)], "k string, v double")
    assert rows(RK.slice_dense_rank(values, ["k"], "v", 2.0)) == sorted(
        [("a", 9.0, 1), ("a", 3.0, 2), ("a", 3.0, 2), ("a", None, 3), (None, 4.0, 1), (None, None, 2)], key=str)


def test_an_absent_metric_makes_the_score_null(spark):
    whole = _metrics(spark)
    first = whole.select("metric_code").first()[0]
    assert SC.projected_score(whole, SC.policy(spark), ["unit"]).first()[1] is not None
    assert SC.projected_score(whole.filter(F.col("metric_code") != first), SC.policy(spark), ["unit"]).first()[1] is None


def test_helpers_are_read_apart_once(spark):
    """Numbering reads the rows twice, tags and first participants once each, and no join sees first participants."""
    from haulmark.plans.ingest import ingest_routes
    spark.createDataFrame(
        [("f", 1, "CX1", "A|B", "x|y"), ("f", 2, "CX1", "C|D", "z|x"), ("f", 3, "CX1", "E|F|G", "u")],
        "file string, line long, `Route Code` string, `Transporter ID` string, `Driver Name` string").write.mode("overwrite").saveAsTable("helper_rows")
    snapshot = F.lit("2025-09-04 14:11:00").cast("timestamp_ntz")
    out = ingest_routes(spark.table("helper_rows"), snapshot, ["file"], ["line"], helper_tags=True, carry=("line",))
    got = {(r.line, r.route_code): (r.driver_name, r.delivery_service_type) for r in out.collect()}
    assert got == {(1, "CX1"): ("x", None), (1, "CX1(1)"): ("y", "Sweeper"), (2, "CX1"): ("z", None), (2, "CX1(2)"): ("x", "Rescue"),
                   (3, "CX1"): ("u", None), (3, "CX1(3)"): (None, None), (3, "CX1(4)"): (None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation spark_catalog.default.helper_rows") <= 4
    spark.sql("DROP TABLE helper_rows")


def test_texts_are_counted_before_they_are_parsed(spark):
    from haulmark.plans import revenue as R, specs as S
    from haulmark.plans.ingest import ingest_table, ingest_totals
    delivered = spark.createDataFrame(
        [("2025-09-01", "Hub (n1)", "3", "Package"), ("2025-09-01", "Hub (n1)", "x", "Package"), ("2025-09-01", "Hub (n1)", "1,000", "Package"),
         ("9/1/2025", "Hub (n1)", None, "Package"), ("9/1/2025", "n1", "2", "my incentive"), (None, "n1", "2", "Package")],
        "`Date` string, `Station` string, `Package Count` string, `Package Type` string")
    service = spark.createDataFrame(
        [("2025-09-01", "Hub (n1)", "A", "8 hr")] * 3 + [("2025-09-01", " Hub (n1)", "A", "8 hr"), ("2025-09-01", None, None, None)],
        "`Date` string, `Station` string, `Service Type` string, `Planned Duration` string")
    work = spark.createDataFrame([("2025-09-01", "n1", "2")] * 2 + [("2025-09-02", "n1", "N/A")], "`Date` string, `Station` string, `AMZL Late Cancel` string")
    training = spark.createDataFrame([("2025-09-01", "n1", "4 Hr")] * 2 + [("2025-09-01", "n1", None)], "`Assignment Date` string, `Station` string, `Total Duration` string")
    rates = spark.createDataFrame([("N1", "A", "2025-W36", 2)], "station_code string, service_type string, iso_year_week string, revenue_rate int").withColumn(
        "revenue_rate", F.col("revenue_rate").cast("decimal(18,4)"))
    sources = [(S.SERVICE_DETAILS, service, ["row_date", "station", "service_type", "planned_duration_label"], []),
               (S.WEEKLY_WORK, work, ["row_date", "station", "amzl_late_cancel"], []),
               (S.DELIVERED_PACKAGES, delivered, ["metric_date", "station", "package_type"], ["package_count"]),
               (S.TRAINING, training, ["assignment_date", "station", "total_hours"], [])]
    window = "2025-08-01", "2025-09-30"
    plain = R.build_revenue_log(*[ingest_table(s, raw) for s, raw, _, _ in sources], rates, *window)
    totals = [ingest_totals(*x) for x in sources]
    got = R.build_revenue_log(*totals, rates, *window, n_rows="n_rows")
    order = lambda df: sorted(map(str, df.collect()))
    assert order(got) == order(plain) and len(order(got)) == 7
    assert [t.count() for t in totals] == [3, 2, 4, 2]
    assert {r.package_count for r in totals[2].collect()} == {1003, None, 2}
