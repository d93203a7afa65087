from __future__ import annotations

import os
import re
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from conftest import BARS
from pyspark.sql import Window, functions as F

from barline.__main__ import main
from barline.operators import quality
from barline.operators.summary import symbol_summary
from barline.plans.metrics import daily_metrics
from barline.plans.pipeline import run_pipeline
from barline.schema import LANDED, PAYLOAD
from barline.session import scratch_path
from barline.sources.payloads import NoDataError, bars_from_payloads
from testbed.bars import damaged_bars, payloads, raw_bars

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return raw_bars(spark, SMALL).cache()


def rows(spark, table):
    return sorted(map(str, spark.table(table).collect()))


def test_runs_are_repeatable(spark, raw):
    folder = scratch_path(spark, "run")
    first = run_pipeline(raw, "repeat", folder)
    tables = (first.metrics, first.signals, first.summary)
    expected = [rows(spark, t) for t in tables]
    assert first.loaded_rows == raw.count() == len(expected[0]) == len(expected[1])
    assert run_pipeline(raw, "repeat", folder) == first
    assert [rows(spark, t) for t in tables] == expected


def layout(spark, table):
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return {k: described.get(k) for k in ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider")}


def test_layout_does_not_depend_on_the_longest_history(spark, raw):
    """One symbol with most of the rows, on days of its own, is laid out like even histories."""
    even = run_pipeline(raw, "even", scratch_path(spark, "run"))
    hot = raw.withColumn(
        "date", F.concat(F.date_add(F.lit("1800-01-01").cast("date"), F.row_number().over(Window.orderBy("symbol", "date"))), F.lit("T00:00:00Z"))
    ).withColumn("symbol", F.lit("HOT"))
    skewed = run_pipeline(raw.unionByName(hot), "skewed", scratch_path(spark, "run"))
    for name in ("landed", "metrics", "signals", "summary"):
        assert layout(spark, getattr(even, name)) == layout(spark, getattr(skewed, name))
    own = spark.table(skewed.metrics).filter("symbol <> 'HOT'")
    assert sorted(map(str, own.collect())) == rows(spark, even.metrics)


def test_each_layer_has_its_namespace(spark, raw):
    layers = run_pipeline(raw, "named", scratch_path(spark, "run"))
    assert layers.staged == "named_staging.bars"

    def stored(database):
        return {(t.name, t.tableType) for t in spark.catalog.listTables(database) if not t.isTemporary}

    assert stored("named_staging") == {("bars", "VIEW")}
    assert {name for name, _ in stored("named_marts")} == {"trade_signals", "symbol_summary"}


def test_nothing_is_shuffled_after_landing(spark, raw):
    layers = run_pipeline(raw, "planned", scratch_path(spark, "run"))
    staged = spark.table(layers.staged)
    steps = {
        "unique": quality.duplicate_keys(staged, ["symbol", "trade_date"]),
        "metrics": daily_metrics(staged),
        "summary": symbol_summary(spark.table(layers.metrics)),
    }
    for step in steps.values():
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "divCash" not in plan
    # Only the totals of the checks leave their partitions.
    plan = quality.check(staged, quality.STAGED_CONSTRAINTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Exchange SinglePartition") == 1 and plan.count("FileScan") == 1


def test_duplicates_stop_the_run_before_the_metrics(spark, raw):
    twice = raw.unionByName(raw.limit(1))
    with pytest.raises(quality.QualityError, match=r"staging.bars: unique\(symbol, trade_date\): 1"):
        run_pipeline(twice, "stopped", scratch_path(spark, "run"))
    assert not spark.catalog.tableExists("stopped_intermediate.daily_metrics")


def test_missing_dates_leave_the_last_run_alone(spark, raw):
    folder = scratch_path(spark, "run")
    layers = run_pipeline(raw, "guarded", folder)
    with pytest.raises(quality.QualityError):
        run_pipeline(raw.withColumn("date", F.lit("never")), "guarded", folder)
    assert spark.table(layers.landed).count() == layers.loaded_rows


def test_missing_dates_stop_the_run(spark, raw):
    broken = raw.withColumn("date", F.when(F.col("divCash") == "0.0", F.col("date")))
    with pytest.raises(quality.QualityError, match=r"landing.bars: not_null\(date\)"):
        run_pipeline(broken, "undated", scratch_path(spark, "run"))


def test_no_rows_leave_the_last_run_alone(spark, raw):
    folder = scratch_path(spark, "run")
    layers = run_pipeline(raw, "kept", folder)
    with pytest.raises(NoDataError):
        run_pipeline(raw.filter("false"), "kept", folder)
    assert spark.table(layers.landed).count() == layers.loaded_rows


def test_checks_count_violations(spark):
    day = date(2024, 1, 2)
    rest = (1.0, 1.0, 1.0, 1.0, 1, 1.0)
    bars = spark.createDataFrame(
        [("A", day, *rest), ("A", day, *rest), (None, day, *rest), ("B", None, *rest), ("C", day, *rest)], BARS
    )
    results = quality.check(bars, quality.STAGED_CONSTRAINTS).collect()
    found = {(r.check_name, r.column_name): r.failures for r in results}
    assert found == {
        ("not_null", "symbol"): 1,
        ("not_null", "trade_date"): 1,
        ("unique", "symbol, trade_date"): 1,
    }
    with pytest.raises(quality.QualityError):
        quality.require(bars, quality.STAGED_CONSTRAINTS, "staged")
    quality.require(bars.filter("symbol = 'C'"), quality.STAGED_CONSTRAINTS, "staged")


def test_unique_ignores_null_in_a_single_key_only(spark):
    two = spark.createDataFrame([(None, 1), (None, 1)], "symbol string, day int")
    assert quality.duplicate_keys(two, ["symbol"]).isEmpty()
    assert quality.duplicate_keys(two, ["symbol", "day"]).first().row_count == 2


def test_command_line(spark, tmp_path, capsys):
    sent, source, target = (str(tmp_path / name) for name in ("sent", "raw", "clean"))
    payloads(spark, SMALL).write.parquet(sent)
    usable = bars_from_payloads(spark.read.parquet(sent)).count()

    assert main(["ingest", sent, source, "--rejected", str(tmp_path / "rejected")]) == 0
    rejected = spark.read.csv(str(tmp_path / "rejected"), header=True)
    assert rejected.columns == ["symbol", "reason"] and not rejected.isEmpty()

    assert main(["clean", f"{source}/*.csv", target, "--files", "1"]) == 0
    (lines,) = (path.read_text().splitlines() for path in Path(target).glob("part-*.csv"))
    keys = [tuple(line.split(",")[:2]) for line in lines[1:]]
    assert lines[0] == ",".join(LANDED.names) and keys == sorted(keys) and len(keys) == usable

    assert main(["build", f"{target}/*.csv", "command", "--location", str(tmp_path / "layers")]) == 0
    assert f"loaded {usable} rows" in capsys.readouterr().out
    assert spark.table("command_marts.trade_signals").count() == usable


def run(*arguments, cwd):
    """A command in a process of its own, in a folder of its own."""
    environment = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    command = [sys.executable, "-m", "barline", *arguments]
    return subprocess.run(command, cwd=cwd, env=environment, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize("located", [True, False])
def test_build_replaces_the_layers_of_an_earlier_process(spark, tmp_path, located):
    where = ["--location", str(tmp_path / "layers")] if located else []
    loaded = []
    for number in (1, 2):
        source = tmp_path / f"raw{number}"
        damaged_bars(spark, SMALL).filter(f"date <> 'some day' AND date < '{1995 + number}'").write.option(
            "header", True
        ).csv(str(source))
        done = run("build", f"{source}/*.csv", "daily", *where, "--rejected", str(tmp_path / "refused"), cwd=tmp_path)
        assert done.returncode == 0, done.stderr[-2000:]
        loaded.append(spark.read.csv(str(source), header=True).count())
        assert f"loaded {loaded[-1]} rows" in done.stdout
        assert "rejected values" in done.stderr
    assert 0 < loaded[0] < loaded[1]
    tables = ("landing.bars", "staging.bars", "intermediate.daily_metrics", "marts.trade_signals")
    counts = ", ".join(f"(SELECT count(*) FROM daily_{table}) AS n{i}" for i, table in enumerate(tables))
    shown = run("sql", f"SELECT {counts}", "daily", *where, cwd=tmp_path)
    assert shown.returncode == 0, shown.stderr[-2000:]
    assert re.findall(r"\d+", shown.stdout.splitlines()[3]) == [str(loaded[1])] * len(tables)
    refused = spark.read.csv(str(tmp_path / "refused"), header=True)
    assert {r.reason for r in refused.select("reason").distinct().collect()} == {"bad_value"}


def test_commands_keep_a_range_of_days(spark, tmp_path):
    raw_bars(spark, SMALL).write.option("header", True).csv(str(tmp_path / "raw"))
    target = str(tmp_path / "clean")
    assert main(["clean", str(tmp_path / "raw"), target, "--start", "1995-01-01", "--end", "1995-01-31"]) == 0
    days = {line.split(",")[1][:7] for path in Path(target).glob("part-*") for line in path.read_text().splitlines()[1:]}
    assert days == {"1995-01"}


def test_rejected_payloads_are_logged(spark, tmp_path, caplog):
    sent = spark.createDataFrame([("A", "not json"), ("B", "[]")], PAYLOAD)
    sent.write.parquet(str(tmp_path / "sent"))
    assert main(["ingest", str(tmp_path / "sent"), str(tmp_path / "raw")]) == 1
    assert "2 rejected payloads" in caplog.text and "A not_json" in caplog.text and "B empty" in caplog.text


def test_ingest_without_usable_payload(spark, tmp_path):
    sent = spark.createDataFrame([("A", "not json")], PAYLOAD)
    sent.write.parquet(str(tmp_path / "sent"))
    assert main(["ingest", str(tmp_path / "sent"), str(tmp_path / "raw")]) == 1
    assert not (tmp_path / "raw").exists()


def test_the_guard_is_given_bars_that_were_parsed_before(spark, monkeypatch):
    import __spark_entry__ as registry

    plans, real = [], registry.payloads.require_data

    def spy(bars):
        plans.append(bars._jdf.queryExecution().optimizedPlan().toString())
        return real(bars)

    monkeypatch.setattr(registry.payloads, "require_data", spy)
    found = {row["payloads"]: row["refused"] for row in registry.queries()["ingest_guard"](spark, SMALL).collect()}
    assert found == {"all": False, "useless": True}
    assert len(plans) == 2 and not any("parseJson" in plan for plan in plans)


def test_layers_are_small_and_their_tasks_too(spark, raw):
    from barline.operators.history import partitions_for

    layers = run_pipeline(raw, "compressed", scratch_path(spark, "run"))
    for table in (layers.landed, layers.metrics, layers.signals, layers.summary):
        assert all(".zstd." in file for file in spark.table(table).inputFiles())
    # 32 MB of long numbers.
    assert partitions_for(spark.range(4_000_000)) == 4
