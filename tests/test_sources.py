from __future__ import annotations

import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest

from barline.operators import quality
from barline.operators.cleaning import clean_bars, date_range, rejected_values, sort_bars, stage_bars, staging_sql
from barline.schema import LANDED, PAYLOAD, RAW
from barline.session import clear_scratch, scratch_path
from barline.sources import files, payloads, tables
from testbed.bars import landed_bars

FIELDS = [name for name in LANDED.names if name != "symbol"]


def record(day="2024-01-02T00:00:00.000Z", **changes):
    values = {name: 1.5 for name in FIELDS} | {"date": day, "volume": 9007199254740993, "adjVolume": 7}
    values.update(changes)
    return {k: v for k, v in values.items() if v is not ...}


@pytest.fixture
def sent(spark):
    good = json.dumps([record(), record("2024-01-03T23:59:59.000Z", close=None)])
    rows = {
        "GOOD": good,
        "TEXT": "not json",
        "NULL": None,
        "CUT": good[:-5],
        "EMPTY": "[]",
        "OBJECT": '{"detail":"x"}',
        "NUMBER": "12",
        "LACKING": json.dumps([record(volume=...)]),
        "MIXED": good[:-1] + ",7]",
        "HOLE": good[:-1] + ",null]",
        "SPREAD": json.dumps([record(volume=...), record(close=...)]),
        "SOON": json.dumps([record("soon"), record()]),
        "WORDS": json.dumps([record(close="high")]),
        "SPACED": "  \n" + good,
        "WHOLE": good.replace("9007199254740993", "1000.0"),
        "EXPONENT": good.replace("9007199254740993", "1e3"),
        "HALF": good.replace("9007199254740993", "10.5"),
        "TRAILING": good + " and more",
        "TWICE": good + good,
        "LISTED": good + "," + good,
        "CLOSED": good + "] and more",
    }
    return spark.createDataFrame(list(rows.items()), PAYLOAD)


def test_payload_rows(sent):
    bars = payloads.bars_from_payloads(sent)
    assert bars.schema.simpleString() == LANDED.simpleString()
    counts = {r.symbol: r["count"] for r in bars.groupBy("symbol").count().collect()}
    usable = {"GOOD": 2, "SPACED": 2, "SPREAD": 2, "SOON": 1, "WORDS": 1, "WHOLE": 2, "EXPONENT": 2, "HALF": 2}
    assert counts == usable
    volumes = {r.symbol: r.volume for r in bars.filter("symbol in ('WHOLE', 'EXPONENT', 'HALF')").collect()}
    assert volumes == {"WHOLE": 1000, "EXPONENT": 1000, "HALF": None}
    first, second = bars.filter("symbol = 'GOOD'").orderBy("date").collect()
    assert first.date == datetime(2024, 1, 2) and second.date == datetime(2024, 1, 3)
    assert first.volume == 9007199254740993 and first.close == 1.5 and second.close is None
    assert bars.filter("symbol = 'WORDS'").first().close is None


def test_quarantine_reasons(sent):
    found = {r.symbol: r.reason for r in payloads.quarantine(sent).collect()}
    assert found == {
        "TEXT": "not_json",
        "NULL": "not_json",
        "CUT": "not_json",
        "EMPTY": "empty",
        "OBJECT": "not_array",
        "NUMBER": "not_array",
        "LACKING": "missing_field",
        "MIXED": "not_array",
        "HOLE": "not_array",
        "SOON": "bad_date",
        "WORDS": "bad_value",
        "HALF": "bad_value",
        **dict.fromkeys(("TRAILING", "TWICE", "LISTED", "CLOSED"), "not_json"),
    }


def test_all_failed_guard(spark, sent):
    bars = payloads.bars_from_payloads(sent)
    assert payloads.require_data(bars) is bars
    with pytest.raises(payloads.NoDataError):
        payloads.require_data(payloads.bars_from_payloads(sent.filter("symbol = 'TEXT'")))


def test_symbols_without_bars(spark, sent):
    universe = sent.select("symbol")
    missing = payloads.symbols_without_bars(universe, payloads.bars_from_payloads(sent))
    assert {r.symbol for r in missing.collect()} == {
        "TEXT", "NULL", "CUT", "EMPTY", "OBJECT", "NUMBER", "LACKING", "MIXED", "HOLE", "TRAILING", "TWICE",
        "LISTED", "CLOSED",
    }


@pytest.fixture
def raw(spark):
    rest = "2.0 5 1.0 1.5 0.5 1.0 5 0.0 1.0".split()
    rows = [
        ("B", "2024-01-02T16:00:00.250Z", "2.0", "3.0", "NaN", *rest),
        ("A", "2024-01-03", "2.0", "3.0", "1.0", *rest),
        ("A", "never", "2.0", "3.0", "1.0", *rest),
    ]
    return spark.createDataFrame(rows, RAW)


def test_clean(raw):
    cleaned = clean_bars(raw)
    assert cleaned.schema.simpleString() == LANDED.simpleString()
    rows = sort_bars(cleaned).collect()
    assert [(r.symbol, r.date) for r in rows] == [
        ("A", None),
        ("A", datetime(2024, 1, 3)),
        ("B", datetime(2024, 1, 2, 16)),
    ]
    assert rows[2].low is None and rows[1].low == 1.0


def test_stage_and_its_view_text_agree(spark, raw):
    landed = clean_bars(raw)
    landed.createOrReplaceTempView("landed_bars")
    staged = stage_bars(landed)
    assert staged.columns[:2] == ["symbol", "trade_date"]
    assert staged.filter("symbol = 'B'").first().trade_date == date(2024, 1, 2)
    assert staged.collect() == spark.sql(staging_sql("landed_bars")).collect()


def test_date_range_is_inclusive_and_reaches_the_scan(spark, raw, tmp_path):
    path = str(tmp_path / "landed")
    clean_bars(raw).write.parquet(path)
    landed = spark.read.parquet(path)
    kept = date_range(landed, date(2024, 1, 2), date(2024, 1, 2))
    assert [r.symbol for r in kept.collect()] == ["B"]
    assert date_range(landed, date(2024, 1, 2), date(2024, 1, 3)).count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in plan


def test_csv_round_trip(spark, raw, tmp_path):
    bars, path = clean_bars(raw), str(tmp_path / "csv")
    assert files.write_bars_csv(bars, path)
    for in_order in (False, True):
        assert files.write_bars_csv(bars, path, in_order, files=1)
        assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    back = files.read_bars_csv(spark, f"{path}/*.csv")
    assert back.schema.simpleString() == LANDED.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, bars.collect()))


def test_cells_that_cannot_be_read(spark, tmp_path):
    path = tmp_path / "raw.csv"
    day = "2024-01-02T00:00:00Z"
    cells = [
        f"A,{day},1,1,1,1,11.0,1,1,1,1,5,0,1",
        f"B,{day},abc,,NaN,1,1e3,1,1,1,1,5.5,0,1",
        "C,never,1,1,1,1,5,1,1,1,1,5,0,1",
    ]
    path.write_text("\n".join([",".join(LANDED.names), *cells]) + "\n")
    raw = files.read_raw_csv(spark, str(path))
    found = {r.symbol: r for r in clean_bars(raw).collect()}
    assert found["A"].volume == 11 and found["B"].volume == 1000 and found["C"].date is None
    assert found["B"].close is None and found["B"].high is None and found["B"].low is None
    assert found["B"].adjVolume is None
    refused = {(r.symbol, r.column_name, r.value, r.reason) for r in rejected_values(raw).collect()}
    assert refused == {
        ("B", "close", "abc", "bad_value"),
        ("B", "adjVolume", "5.5", "bad_value"),
        ("C", "date", "never", "bad_date"),
    }


@pytest.mark.parametrize("number", [1, 3, 4])
def test_sorted_files_follow_each_other(spark, tmp_path, number):
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        bars = landed_bars(spark, "/root/testdata/sf0.001").repartition(16)
        assert files.write_bars_csv(bars, str(tmp_path / "csv"), in_order=True, files=number)
    finally:
        spark.conf.set(merging, before)
    parts = sorted((tmp_path / "csv").glob("part-*.csv"))
    keys = [tuple(line.split(",")[:2]) for part in parts for line in part.read_text().splitlines()[1:]]
    assert len(parts) == number and len(keys) == bars.count() and keys == sorted(keys)


def test_nothing_to_write(spark, raw, tmp_path):
    path = tmp_path / "csv"
    assert not files.write_bars_csv(clean_bars(raw).filter("false"), str(path))
    assert not path.exists()


def test_csv_with_bad_rows(spark, tmp_path):
    header = ",".join(LANDED.names)
    good = "A,2024-01-02 00:00:00,1,1,1,1,5,1,1,1,1,5,0,1"
    path = tmp_path / "bars.csv"
    path.write_text(f"{header}\n{good}\nA,2024-01-03 00:00:00,high,1,1,1,5,1,1,1,1,5,0,1\n")
    kept, bad = files.split_corrupt(files.read_bars_csv(spark, str(path), mode="PERMISSIVE"))
    assert kept.columns == LANDED.names and len(kept.collect()) == 1 and len(bad.collect()) == 1
    assert len(kept.select("symbol").collect()) == 1
    assert [r[files.CORRUPT].startswith("A,2024-01-03") for r in bad.collect()] == [True]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_bars_csv(spark, str(path)).collect()


def test_csv_header_must_match(spark, tmp_path):
    names = LANDED.names.copy()
    names[2], names[3] = names[3], names[2]
    path = tmp_path / "bars.csv"
    path.write_text(",".join(names) + "\nA,2024-01-02 00:00:00,1,1,1,1,5,1,1,1,1,5,0,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_bars_csv(spark, str(path)).collect()


def test_write_dispositions(spark, raw, tmp_path):
    tables.ensure_database(spark, "dispositions", str(tmp_path / "db"))
    tables.ensure_database(spark, "dispositions")
    table, bars = "dispositions.bars", clean_bars(raw)
    assert tables.write_table(bars.filter("false"), table, "empty") == 0
    assert tables.write_table(bars, table, "empty") == 3
    with pytest.raises(tables.TableNotEmptyError):
        tables.write_table(bars, table, "empty")
    assert tables.write_table(bars, table, "append") == 3
    assert spark.table(table).count() == 6
    assert tables.write_table(bars, table) == 3
    assert spark.table(table).count() == 3


def test_files_of_another_session_are_found(spark, raw, tmp_path):
    tables.ensure_database(spark, "found", str(tmp_path / "db"))
    bars = clean_bars(raw)
    tables.write_table(bars, "found.bars")
    for disposition, rows in (("append", 6), ("truncate", 3)):
        spark.sql("DROP TABLE found.bars")  # what a catalog in memory forgets; the files stay
        assert tables.write_table(bars, "found.bars", disposition) == 3
        assert spark.table("found.bars").count() == rows
    spark.sql("DROP TABLE found.bars")
    with pytest.raises(tables.TableNotEmptyError):
        tables.write_table(bars, "found.bars", "empty")


def test_load_replaces_the_table(spark, raw, tmp_path):
    tables.ensure_database(spark, "loads", str(tmp_path / "db"))
    path = str(tmp_path / "csv")
    files.write_bars_csv(clean_bars(raw), path)
    for _ in range(2):
        assert tables.load_bars(spark, f"{path}/*.csv", "loads.bars") == 3
    assert spark.table("loads.bars").count() == 3


def test_bucketed_table_needs_no_shuffle(spark, raw, tmp_path):
    tables.ensure_database(spark, "buckets", str(tmp_path / "db"))
    tables.write_table(clean_bars(raw), "buckets.bars", buckets=tables.Buckets(2, order="date"))
    plan = quality.duplicate_keys(spark.table("buckets.bars"), ["symbol", "date"])._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_union_matches_by_name(raw):
    turned = raw.select(*reversed(raw.columns))
    both = tables.union_batches(raw, turned)
    assert both.columns == raw.columns
    assert both.count() == 6 and both.select("symbol").distinct().count() == 2


def test_run_sql(spark, raw):
    rows = tables.run_sql(spark, "SELECT symbol, count(*) AS n FROM {bars} GROUP BY symbol", bars=raw).collect()
    assert {r.symbol: r.n for r in rows} == {"A": 2, "B": 1}


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_can_be_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")


def test_payloads_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([("A", "[]")], PAYLOAD).write.parquet(str(tmp_path / "sent"))
    sent = spark.read.parquet(str(tmp_path / "sent"))
    for df in (payloads.bars_from_payloads(sent), payloads.quarantine(sent)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
    # Each of the ten decimals is read once.
    plan = payloads.bars_from_payloads(sent)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double)") == 10


def test_values_of_rejections_are_read_once(spark, tmp_path):
    spark.createDataFrame([("A", "[]")], PAYLOAD).write.parquet(str(tmp_path / "sent"))
    refused = payloads.quarantine(spark.read.parquet(str(tmp_path / "sent")))
    files.write_bars_csv(landed_bars(spark, "/root/testdata/sf0.001"), str(tmp_path / "csv"))
    rejected = rejected_values(files.read_raw_csv(spark, str(tmp_path / "csv")))
    for df in (refused, rejected):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter " in line]
        assert filters and not any("cast(" in line for line in filters)


def test_files_in_order_are_not_sorted_by_the_tasks_that_write_them(spark, tmp_path, monkeypatch):
    bars = landed_bars(spark, "/root/testdata/sf0.001").localCheckpoint()
    monkeypatch.setattr(files, "partitions_for", lambda df: 11)
    plans, real = [], files._in_files

    def spy(*args):
        out = real(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(files, "_in_files", spy)
    path = str(tmp_path / "sorted")
    assert files.write_bars_csv(bars, path, in_order=True, files=3)
    above, below = plans[0].split("REPARTITION_BY_NUM", 1)
    assert "Coalesce 3" in above and "Sort [" not in above and "Sort [symbol" in below
    parts = sorted((tmp_path / "sorted").glob("part-*.csv"))
    assert len(parts) == 3
    lines = [line for part in parts for line in part.read_text().splitlines()[1:]]
    assert min(len(part.read_text().splitlines()) for part in parts) > bars.count() / 6
    assert lines == sorted(lines, key=lambda line: (line.split(",")[LANDED.names.index("symbol")], line.split(",")[LANDED.names.index("date")]))
    key = lambda row: (row["symbol"], row["date"])
    assert sorted(files.read_bars_csv(spark, path).collect(), key=key) == sorted(bars.collect(), key=key)


def test_a_gate_checks_small_partitions_and_leaves_the_setting(spark, monkeypatch):
    name, seen, real = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], quality.check
    monkeypatch.setattr(quality, "check", lambda *a: (seen.append(spark.conf.get(name)), real(*a))[1])
    before = spark.conf.get(name)
    quality.require(spark.createDataFrame([("A", date(2024, 1, 2))], "symbol string, trade_date date"), quality.STAGED_CONSTRAINTS, "x")
    assert seen == ["4m"] and spark.conf.get(name) == before
