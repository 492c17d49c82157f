import datetime as dt
import gzip
import json

import pytest

from tapespark.operators.outcomes import outcomes, run_summary
from tapespark.plans import ingest
from tapespark.plans.ingest import ingest_day, ingest_range, read_outcomes, read_rejects, read_trades
from tapespark.sources import feed_calendar


def feed_name(day, digit=6):
    return f"data_feeds_{day}_{day}_IEXTP1_TOPS1.{digit}.pcap.gz"


def put(folder, day, *lines):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / feed_name(day), "wt") as out:
        out.writelines(f"{line}\n" for line in lines)


def good(day, n=1):
    return f"trade_report,{day[:4]}-{day[4:6]}-{day[6:]}T10:00:00,A,{n},1.5,{n}"


def calendar(spark, start, end):
    return feed_calendar(spark, start, end, "raw/", "out/").orderBy("trade_date").collect()


def test_calendar_cutover_and_names(spark):
    last, first = calendar(spark, "20171031", "20171101")
    assert (last.version, first.version) == ("1.5", "1.6")
    assert last.input_path == "raw/data_feeds_20171031_20171031_IEXTP1_TOPS1.5.pcap.gz"
    assert first.file_name == feed_name("20171101")
    assert first.output_path == "out/date=2017-11-01"


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("20240106", "20240107", 0),
        ("20240105", "20240108", 2),
        ("20240105", "20240105", 1),
        ("20240108", "20240105", 0),
        ("20161212", "20180731", 427),
    ],
)
def test_calendar_length(spark, start, end, days):
    assert len(calendar(spark, start, end)) == days


def test_outcome_of_each_kind(spark):
    days = feed_calendar(spark, "20240101", "20240105", "raw/", "out/")
    done = spark.createDataFrame([("20240101",), ("20240101",)], "date_str string")
    files = spark.createDataFrame([(feed_name(d),) for d in ("20240103", "20240104", "20240105")], "file_name string")
    counts = spark.createDataFrame([("20240105", 7), ("20240104", 0)], "date_str string, rows long")
    errors = spark.createDataFrame([("20240103", "torn")], "date_str string, error string")
    got = outcomes(days, done, files, counts, errors).orderBy("date_str").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("SKIPPED", None, "already exists"),
        ("FAILED", None, "missing file"),
        ("FAILED", None, "torn"),
        ("FAILED", None, "no trade_report rows"),
        ("SUCCESS", 7, None),
    ]
    summary = {r.status: r for r in run_summary(outcomes(days, done, files, counts, errors)).collect()}
    assert [e.date for e in summary["FAILED"].entries] == ["20240102", "20240103", "20240104"]
    assert (summary["SUCCESS"].dates, summary["SUCCESS"].total_rows) == (1, 7)


def test_range_run_twice(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw, "20240101", good("20240101", 1), good("20240101", 2), "trade_report,broken")
    put(raw, "20240102", "quote_update,x")
    put(raw, "20240103", "trade_report,malformed,only")
    put(raw, "20240105", good("20240105"))
    # A gzip cut short, and one which never was.
    whole = gzip.compress("\n".join(good("20240108", n) for n in range(20000)).encode())
    (raw / feed_name("20240108")).write_bytes(whole[: len(whole) // 2])
    (raw / feed_name("20240109")).write_bytes(b"not gzip at all")
    args = (dt.date(2024, 1, 1), "20240109", f"{raw}/", str(out))

    first = {r.date_str: r for r in ingest_range(spark, *args).collect()}
    assert {d: (r.status, r.rows) for d, r in first.items()} == {
        "20240101": ("SUCCESS", 2),
        "20240102": ("FAILED", None),
        "20240103": ("FAILED", None),
        "20240104": ("FAILED", None),
        "20240105": ("SUCCESS", 1),
        "20240108": ("FAILED", None),
        "20240109": ("FAILED", None),
    }
    assert {d: r.rejected for d, r in first.items() if r.rejected} == {"20240101": 1, "20240103": 1}
    assert {(r.date.day, r.reason) for r in read_rejects(spark, str(out)).collect()} == {
        (1, "field count"), (3, "field count")
    }
    assert first["20240104"].reason == "missing file"
    assert first["20240108"].reason.startswith("unreadable file")
    assert first["20240102"].reason == "no trade_report rows"

    put(raw, "20240104", good("20240104"))
    put(raw, "20240108", good("20240108"))
    second = {r.date_str: r.status for r in ingest_range(spark, *args).collect()}
    assert [second[d] for d in sorted(second)] == [
        "SKIPPED", "FAILED", "FAILED", "SUCCESS", "SKIPPED", "SUCCESS", "FAILED",
    ]
    third = {r.date_str: r.status for r in ingest_range(spark, *args).collect()}
    assert [third[d] for d in sorted(third)] == [
        "SKIPPED", "FAILED", "FAILED", "SKIPPED", "SKIPPED", "SKIPPED", "FAILED",
    ]
    assert read_outcomes(spark, str(out)).count() == 21
    stored = read_trades(spark, str(out)).collect()
    assert sorted((r.date.day, r.sale_size) for r in stored) == [(1, 1), (1, 2), (4, 1), (5, 1), (8, 1)]

    [part] = (out / "summary_20240101_20240109.json").glob("*.json")
    document = json.loads(part.read_text())
    assert [e["date"] for e in document["skipped"]] == ["20240101", "20240104", "20240105", "20240108"]
    assert document["success"] == []


def test_a_run_which_died_before_recording_is_made_good(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw, "20240101", good("20240101"), good("20240101", 2))
    stale = out / "trades" / "date=2024-01-01"
    spark.range(5).selectExpr("'x' as type", "id as sale_size").write.parquet(str(stale))
    assert ingest_range(spark, "20240101", "20240101", f"{raw}/", str(out)).first().rows == 2
    assert read_trades(spark, str(out)).count() == 2


def test_empty_range_and_no_files(spark, tmp_path):
    assert ingest_range(spark, "20240106", "20240107", f"{tmp_path}/raw/", f"{tmp_path}/a").count() == 0
    got = ingest_range(spark, "20240101", "20240101", f"{tmp_path}/raw/", f"{tmp_path}/b").collect()
    assert [(r.status, r.reason) for r in got] == [("FAILED", "missing file")]


def test_single_day(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "20240101", good("20240101"))
    put(raw, "20240102", good("20240102"))
    got = ingest_day(spark, str(raw / feed_name("20240102")), out).collect()
    assert [(r.date_str, r.status, r.rows) for r in got] == [("20240102", "SUCCESS", 1)]
    assert [r.date for r in read_trades(spark, out).collect()] == [dt.date(2024, 1, 2)]
    with pytest.raises(ValueError):
        ingest_day(spark, "raw/other.gz", out)


def test_rows_of_a_date_without_outcome_are_not_seen(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw, "20240101", "quote_update,x")
    stale = out / "trades" / "date=2024-01-01"
    spark.range(5).selectExpr("'x' as type", "id as sale_size").write.parquet(str(stale))
    got = ingest_range(spark, "20240101", "20240101", f"{raw}/", str(out)).first()
    assert (got.status, got.reason) == ("FAILED", "no trade_report rows")
    assert read_trades(spark, str(out)).count() == 0


def test_a_torn_file_leaves_the_other_days_written_once(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    for day in ("20240101", "20240103"):
        put(raw, day, good(day))
    for day in ("20240102", "20240104", "20240105", "20240108"):
        (raw / feed_name(day)).write_bytes(b"not gzip at all")
    got = ingest_range(spark, "20240101", "20240108", f"{raw}/", str(out)).collect()
    assert sorted(r.status for r in got) == ["FAILED"] * 4 + ["SUCCESS"] * 2
    for day in ("2024-01-01", "2024-01-03"):
        folder = out / "trades" / f"date={day}"
        assert len({p.name.split("-", 2)[2] for p in folder.glob("part-*.parquet")}) == 1
    assert read_trades(spark, str(out)).count() == 2


@pytest.mark.parametrize("end", ["", "/", "//"])
def test_prefix_with_and_without_slash(spark, tmp_path, end):
    put(tmp_path / "raw", "20240101", good("20240101"))
    got = ingest_range(spark, "20240101", "20240101", f" {tmp_path}/raw{end}", f"{tmp_path}/out").first()
    assert got.status == "SUCCESS"


def test_a_given_file_is_taken_whatever_its_protocol(spark, tmp_path):
    put(tmp_path / "raw", "20240102", good("20240102"))
    named = tmp_path / "raw" / feed_name("20240102", 5)
    (tmp_path / "raw" / feed_name("20240102")).rename(named)
    assert ingest_day(spark, str(named), str(tmp_path / "out")).first().status == "SUCCESS"
    other = str(tmp_path / "raw" / feed_name("20240103"))
    assert ingest_day(spark, other, str(tmp_path / "out")).first().reason == "missing file"


def test_rejects_of_a_died_run_are_not_seen(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw, "20240101", good("20240101"), "trade_report,broken")
    ingest._load(spark, str(raw / feed_name("20240101")), dt.date(2024, 1, 1), str(out), "died")
    put(raw, "20240101", good("20240101"))
    assert ingest_range(spark, "20240101", "20240101", f"{raw}/", str(out)).first().rejected == 0
    assert read_rejects(spark, str(out)).count() == 0
    assert read_trades(spark, str(out)).count() == 1


def test_a_range_without_rejects_or_files_has_none(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "20240101", good("20240101"))
    ingest_range(spark, "20240101", "20240101", f"{raw}/", f"{tmp_path}/a")
    ingest_range(spark, "20240102", "20240102", f"{raw}/", f"{tmp_path}/b")
    for out in ("a", "b"):
        rejects = read_rejects(spark, f"{tmp_path}/{out}")
        assert rejects.columns == ["payload", "reason", "date"] and rejects.count() == 0
    assert read_trades(spark, f"{tmp_path}/b").count() == 0


def test_a_day_loaded_again_is_whole_before_and_after(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "20240101", good("20240101", 1), "trade_report,old")
    ingest_range(spark, "20240101", "20240101", f"{raw}/", out)
    put(raw, "20240101", good("20240101", 2), good("20240101", 3), "trade_report,new")
    assert ingest_range(spark, "20240101", "20240101", f"{raw}/", out).first().status == "SKIPPED"

    def seen():
        trades = sorted(r.sale_size for r in read_trades(spark, out).collect())
        return trades, [r.payload for r in read_rejects(spark, out).collect()]

    # A second attempt's files are there, but not on record yet.
    ingest._load(spark, str(raw / feed_name("20240101")), dt.date(2024, 1, 1), out, "under way")
    assert seen() == ([1], ["trade_report,old"])
    got = ingest_day(spark, str(raw / feed_name("20240101")), out, again=True).first()
    assert (got.status, got.rows, got.rejected) == ("SUCCESS", 2, 1)
    assert seen() == ([2, 3], ["trade_report,new"])
    # What fails later does not take the finished day away.
    (raw / feed_name("20240101")).write_bytes(b"not gzip at all")
    assert ingest_day(spark, str(raw / feed_name("20240101")), out, again=True).first().status == "FAILED"
    assert seen() == ([2, 3], ["trade_report,new"])


def test_days_are_loaded_as_the_slots_allow(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    days = [f"202401{d:02d}" for d in (1, 2, 3, 4, 5)]
    for day in days:
        put(raw, day, good(day))
    asked = []
    pool = ingest.ThreadPoolExecutor
    monkeypatch.setattr(ingest, "ThreadPoolExecutor", lambda n: asked.append(n) or pool(n))
    ingest_range(spark, "20240101", "20240105", f"{raw}/", f"{tmp_path}/a")
    ingest_range(spark, "20240101", "20240105", f"{raw}/", f"{tmp_path}/b", at_once=2)
    assert asked == [min(5, spark.sparkContext.defaultParallelism), 2]
    assert read_trades(spark, f"{tmp_path}/b").count() == 5


def test_a_day_is_decoded_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "20240101", good("20240101"), "trade_report,broken")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("decoded-once", "")
    try:
        assert ingest._load(spark, str(raw / feed_name("20240101")), dt.date(2024, 1, 1), out, "run") == (1, 1)
        assert len(tracker.getJobIdsForGroup("decoded-once")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
