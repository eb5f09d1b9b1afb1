"""Whole runs over small folders of export files."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from haulmark.plans import jobs, specs as S
from haulmark.sources import exports as X

NOW = dt.datetime(2025, 9, 10, 8, 0)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("exports")
    sub = root / "week 36"
    sub.mkdir()

    def put(name, text, where=root):
        (where / name).write_text(text, encoding="utf-8")

    put("AssociateData.csv",
        "Name and ID,Transporter ID,Position,Status,Work Phone Number\n"
        "Ann A,T1,Driver,Active,1\nBob,T2,,Active,\n,T3,x,Active,2\nNo Id,,x,Active,3\nAnn A,T1,,,9\n")
    put("Routes_DSW3_2025-09-04_14_11 (PDT).csv",
        "Route Code,DSP,Transporter ID,Driver Name,All Stops\n"
        'CX1,SFNL,A|B|C,x|y,"1,010"\nCX2,SFNL,D,z,5\nCX1,SFNL,E|F,e|f,7\n')
    # Another header order and a shorter header in the same class of files.
    put("Routes_DSW3_2025-09-05_14_11.csv", "Driver Name,Route Code,Transporter ID\nq,CX9,Q1\n", sub)
    put("Itineraries_DSW3_2025-09-04_23-51.csv",
        "Transporter ID,Route Code,All Stops,Progress Status\nT1,IS7|CX8,12,\"on\ntime\"\nT2,,3,ok\n")
    put("DSP_Delivery_Overview_ALL_2025-09-06.csv",
        "Metric,2025-09-01,09/02/2025,note\nDCR,99.5%,\"1,000\",x\nPOD,,97,y\n")
    put("DSP_Delivery_Overview_ALL_2025-W36.csv", "Metric,Week 35,Week 36\nDCR,1,2\n", sub)
    put("DSP_Overview_Dashboard_2025-W36.csv",
        "Week,Delivery Associate,Transporter ID,Overall Score,Sign/Signal Violations Rate (per trip),DCR\n"
        "2025-W36,Ann A,T1,score 89.5 ok,0.25,99.1%\n2025-W36,Ann A,t1 ,1,1,1\n2025-W36,Bob,T2,-,,98\n")
    put("Safety_Dashboard_1.csv",
        "Date,Event ID,Date Time (PDT/PST),Metric Type,Transporter ID\n"
        "9/1/2025,5000000001,9/1/2025 2:05 PM,Speeding,T1\nbad,7,,Speeding,T1\n")
    put("notes.csv", "a\n1\n")
    put("Fleet.csv", "VIN,Service Type,Status\nV1,Van,Active\n")
    put("Routes_DSW3_2025-09-06.xlsx", "not read")
    put("DA_Tenure_Workforce_DAs_Report.csv", "Transporter ID,Name,Year,Week\nT9,New N,2025,36\n")

    def member(rows):
        return "\n".join(rows) + "\n"

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("x Service Details Report.csv", member(
            ["Date,Station,Delivery Associate,Route,Planned Duration,Service Type,Excluded?"]
            + [f"2025-09-0{1 + i % 7},Dallas (DSW3),ann a ,CX{i},10 hr,10Hr Rt," for i in range(31)]
            + ["2025-09-01,Dallas (DSW3),ann a,CX99,10 hr,10Hr Rt,Y"]))
        z.writestr("x Delivered Packages Report.csv",
                   "Station,Date,Package Count,Package Type,Package Details\n"
                   '"Dallas (DSW3)",2025-09-01,"1,200",Delivered Package,"a\nb"\n'
                   "Dallas (DSW3),2025-09-01,9,Delivered Package,\"a\nb\"\n")
        z.writestr("x Training Weekly Report.csv",
                   "Assignment Date,Station,Total Duration\n2025-09-02,Dallas (DSW3),8 Hr\n")
        z.writestr("x Unplanned Delay Weekly Report.csv",
                   "Date,Station,Unplanned Delay,Total Delay In Minutes\n2025-09-02,DSW3,weather,30\n")
        z.writestr("x Weekly Report.csv", "Date,Station,AMZL Late Cancel\n2025-09-03,Dallas (DSW3),2\n")
        z.writestr("readme.txt", "no")
        z.writestr("other.csv", "a\n1\n")
    (sub / "SFNL Weekly Report.zip").write_bytes(buffer.getvalue())
    return str(root)


def test_listing_routes_names(spark, folder):
    got = {r.file_name: r.table for r in X.list_files(spark, folder).collect()}
    assert got["SFNL Weekly Report.zip"] == "(bundle)"
    assert got["Routes_DSW3_2025-09-04_14_11 (PDT).csv"] == "routes"
    assert got["DSP_Delivery_Overview_ALL_2025-W36.csv"] == "weekly_overview"
    assert got["notes.csv"] == "(unmatched)"


def test_rows_follow_each_files_own_header(spark, folder):
    rows = X.read_table_rows(spark, folder, S.ROUTES, "routes").orderBy(*X.ORIGIN).collect()
    assert [(r["route code"], r["driver name"], r["dsp"]) for r in rows] == [
        ("CX1", "x|y", "SFNL"), ("CX2", "z", "SFNL"), ("CX1", "e|f", "SFNL"), ("CX9", "q", None)]


def test_files_of_any_width(spark, tmp_path):
    days = [f"2024-{1 + k // 28:02d}-{1 + k % 28:02d}" for k in range(300)] + [f"2025-{1 + k // 28:02d}-{1 + k % 28:02d}" for k in range(100)]
    lines = ["Metric," + ",".join(days)]
    lines += [f"M{k}," + ",".join("" if j == k else str(j) for j in range(400)) for k in range(0, 400, 37)]
    (tmp_path / "wide.csv").write_text("\n".join([*lines, "T,1,,,,", 'Q,"1,000",2', "S," + "1," * 400 + "9"]) + "\n")
    (tmp_path / "narrow.csv").write_text('Metric,x,y\nA,1,2\nB,1,2,3\nC,1,2,,\nD,1,2,,"4,5"\n')
    cells = X.read_matrix_cells(spark, str(tmp_path))
    got = {(r.metric, r.label): r.cell for r in cells.filter("file_name = 'wide.csv'").collect()}
    for k in range(0, 400, 37):
        assert [got[f"M{k}", d] for d in days] == [None if j == k else str(j) for j in range(400)]
    assert got["Q", days[0]] == "1,000" and got["T", days[0]] == "1" and ("S", days[0]) not in got
    assert {r.metric for r in cells.filter("file_name = 'narrow.csv'").collect()} == {"A", "C"}
    surplus = {(r.file_name, r.cells[0]): r.surplus for r in X.read_surplus_rows(spark, str(tmp_path)).collect()}
    assert set(surplus) == {("wide.csv", "S"), ("narrow.csv", "B"), ("narrow.csv", "D")}
    assert surplus["narrow.csv", "B"] == ["3"] and surplus["wide.csv", "S"][-1].endswith("9")


def test_archive_rows_of_any_width():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.csv", "Date,Station,Date\n2025-09-03,DSW3\n2025-09-03,DSW3,x,extra\n2025-09-03,DSW3,x,,\n")
    got = [(cells, surplus) for _, method, data in X.archive_members(buffer.getvalue()) for _, cells, surplus in X.member_rows(data, method)]
    assert got == [({"date": "2025-09-03", "station": "DSW3"}, None), ({"date": "2025-09-03", "station": "DSW3"}, ["extra"]),
                   ({"date": "2025-09-03", "station": "DSW3"}, None)]


def test_bundle_members(spark, folder):
    rows = X.read_bundle_rows(spark, folder)
    counts = {r.table: r["count"] for r in rows.groupBy("table").count().collect()}
    assert counts == {
        "wst_service_details": 32, "wst_delivered_packages": 2, "wst_training_weekly_report": 1,
        "wst_unplanned_delay": 1, "wst_weekly_report": 1, "(unmatched)": 1}
    parcels = X.bundle_table_rows(rows, S.DELIVERED_PACKAGES).collect()
    assert {p["package details"] for p in parcels} == {"a\nb"}


def test_directory_run_is_complete_and_repeatable(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS dsp_test")
    db = "dsp_test"
    state = []
    for _ in range(2):
        report = jobs.ingest_directory(spark, folder, db, NOW)
        state.append({
            t.name: sorted(map(str, spark.table(f"{db}.{t.name}").collect()))
            for t in spark.catalog.listTables(db)
            if t.name not in S.ALL_SPECS or S.ALL_SPECS[t.name].mode != "append"})
    assert state[0] == state[1] and len(state[0]) >= 10

    people = {r.transporter_id: r for r in spark.table(f"{db}.associate").collect()}
    assert set(people) == {"T1", "T2"}
    assert (people["T1"].work_phone, people["T1"].position_title) == ("9", "Driver")
    routes = {(r.route_code, r.transporter_id, r.driver_name, r.all_stops) for r in
              spark.table(f"{db}.routes").filter("snapshot_dt < '2025-09-05'").collect()}
    assert routes == {("CX1", "A", "x", 1010), ("CX1(1)", "B", "y", None), ("CX1(2)", "C", None, None),
                      ("CX2", "D", "z", 5), ("CX1", "E", "e", 7), ("CX1(3)", "F", "f", None)}
    trips = {r.transporter_id: r for r in spark.table(f"{db}.itineraries").collect()}
    assert trips["T1"].station_code == "dsw2" and trips["T1"].progress_status == "on\ntime"
    assert trips["T1"].file_datetime == dt.datetime(2025, 9, 4, 23, 51) and trips["T2"].route_code is None
    daily = {(str(r.metric_date), r.metric_name): r.metric_value for r in
             spark.table(f"{db}.daily_overview").collect()}
    assert float(daily["2025-09-02", "DCR"]) == 1000 and daily["2025-09-01", "POD"] is None and len(daily) == 4
    weekly = {(r.year, r.week): float(r.metric_value) for r in spark.table(f"{db}.weekly_overview").collect()}
    assert weekly == {(2025, 35): 1.0, (2025, 36): 2.0}
    cards = {r.transporter_id: r for r in spark.table(f"{db}.weekly_scorecard").collect()}
    assert set(cards) == {"T1", "T2"} and float(cards["T1"].overall_score) == 89.5
    assert float(cards["T1"].sign_signal_viol_rate) == 0.25
    assert spark.table(f"{db}.safety_events").count() == 1
    assert spark.table(f"{db}.safety_events_rejected").first().failed == ["event_date missing"]
    assert spark.table(f"{db}.wst_delivered_packages").first().package_count == 1200
    counts = {(r.file_name, r.table): r.rows for r in report.collect()}
    assert counts["notes.csv", "(unmatched)"] == 0
    assert counts["Routes_DSW3_2025-09-06.xlsx", "routes"] == 0 and counts["Fleet.csv", "fleet_vehicles"] == 1
    assert spark.table(f"{db}.fleet_vehicles").first().vin == "V1"
    assert counts["SFNL Weekly Report.zip", "wst_service_details"] == 32

    jobs.update_tenure(spark, db)
    staff = spark.table(f"{db}.tenured_workforce").collect()
    assert [(s.transporter_id, s.routes_at_tenure, s.tenured_date) for s in staff] == [
        ("T1", 31, dt.date(2025, 9, 7))]

    sheet = spark.createDataFrame(
        [(1, "Dallas (dsw3)", "10Hr Rt", "8", "36.25"), (2, "Dallas (dsw3)", "any package", "0", "0.10"),
         (3, "Dallas (dsw3)", "Amazon Cancellation", "0", "200.00"), (4, " ", "x", "0", "1"),
         (5, "Dallas (dsw3)", "Training Classes", "0", "29.50")],
        "line int, Station string, Service_type string, `Billable hours` string, revenue_rate string")
    for _ in range(2):
        jobs.revenue_week(spark, sheet, "2025-W36", db, dt.date(2025, 9, 1))
    log = spark.table(f"{db}.revenue_log")
    total = {r.service_type: float(r.total) for r in
             log.groupBy("service_type").agg({"revenue_total": "sum"}).toDF("service_type", "total").collect()}
    # Two runs appended the training and weekly report twice: they have no duplicate rule.
    assert total == {"10Hr Rt": 32 * 10 * 36.25, "Package": 120.0, "Amazon Cancellation": 800.0,
                     "Training Classes": 2 * 8 * 29.5}
    before = sorted(map(str, log.collect()))
    jobs.revenue_recent(spark, db, dt.date(2025, 9, 10))
    assert sorted(map(str, spark.table(f"{db}.revenue_log").collect())) == before
    with pytest.raises(ValueError):
        jobs.revenue_week(spark, sheet.drop("revenue_rate"), "2025-W36", db, dt.date(2025, 9, 1))

    jobs.merge_tenure_report(spark, db, NOW)
    assert {s.transporter_id for s in spark.table(f"{db}.tenured_workforce").collect()} >= {"T1"}
    twice = spark.table(f"{db}.safety_events")
    twice.withColumn("source", F.lit("later")).write.insertInto(f"{db}.safety_events")
    assert spark.table(f"{db}.safety_events").count() == 2
    purged = jobs.purge_all(spark, db)
    assert {t: p for t, p in purged.items() if p} == {"safety_events": ["2025-09-01"]}
    assert [r.source for r in spark.table(f"{db}.safety_events").collect()] == ["later"]


def test_backlog_file(spark, tmp_path):
    (tmp_path / "backlog.csv").write_text(
        "Day,Transporter ID,Route Code,App Sign In\n4/29/2025,\"T1,x\",\"IS1, CX2|CX2\",4/29/2025 7:30 AM\n"
        "45776,T2,,\nbad,,CX1,\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS dsp_backlog")
    for _ in range(2):
        jobs.ingest_backlog_file(spark, str(tmp_path), "dsp_backlog")
    got = {(r.transporter_id, r.route_code, r.station_code, r.file_datetime, r.app_sign_in_time)
           for r in spark.table("dsp_backlog.itineraries").collect()}
    at = dt.datetime(2025, 4, 29, 23)
    signed = dt.datetime(2025, 4, 29, 7, 30)
    assert got == {("T1", "IS1", "dsw2", at, signed), ("T1", "CX2", "dsw2", at, signed),
                   ("T2", None, None, at, None)}
    assert spark.table("dsp_backlog.itineraries").count() == 3
