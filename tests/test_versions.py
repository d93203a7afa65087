"""Replacing tables and layers: whatever fails, readers find the old rows; and the store of bars by year."""

from __future__ import annotations

import re
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import BARS
from pyspark.sql import functions as F

from barline.__main__ import main
from barline.operators import quality
from barline.operators.summary import merged_summary, summary_parts, symbol_summary
from barline.plans import metrics as m, pipeline, store
from barline.session import intermediates, scratch_path
from barline.sources import tables, versions
from testbed.bars import raw_bars, staged_bars

SMALL = "/root/testdata/sf0.001"


class Broken(RuntimeError):
    pass


def fail(*args, **named):
    raise Broken


def numbers(spark, n):
    return spark.range(n).withColumn("symbol", F.concat(F.lit("S"), F.col("id") % 3)).withColumn("trade_date", F.lit("2024-01-01").cast("date"))


def failing(df):
    return df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))


@pytest.fixture
def database(spark, tmp_path):
    name = f"faults_{abs(hash(str(tmp_path)))}"
    tables.ensure_database(spark, name, str(tmp_path / "db"))
    return name


@pytest.mark.parametrize("buckets", [None, tables.Buckets(2)])
@pytest.mark.parametrize("step", ["write", "accept", "commit", "rename", "register"])
def test_a_failed_replacement_leaves_the_old_rows(spark, database, monkeypatch, step, buckets):
    table = f"{database}.bars"
    tables.write_table(numbers(spark, 5), table, buckets=buckets)
    new, accept = numbers(spark, 9), lambda counts: None
    if step == "write":
        new = failing(new)
    elif step == "accept":
        accept = fail
    elif step == "commit":
        monkeypatch.setattr(versions, "commit", fail)
    elif step == "rename":
        monkeypatch.setattr(versions, "rename", lambda *a: False)
    else:
        monkeypatch.setattr(tables, "point", _once(tables.point))
    with pytest.raises(Exception):
        tables.write_table(new, table, buckets=buckets, accept=accept)
    monkeypatch.undo()
    assert spark.table(table).count() == 5
    # A session that knows no names finds the same rows, and no folder of the failed write is left.
    spark.sql(f"DROP TABLE {table}")
    assert tables.register(spark, table, buckets) and spark.table(table).count() == 5
    root = Path(tables.table_path(spark, table).removeprefix("file:"))
    assert len([p for p in root.iterdir() if not p.name.startswith("_")]) == 1
    assert not spark.catalog.tableExists(f"{table}__next")
    assert tables.write_table(new if step != "write" else numbers(spark, 9), table, buckets=buckets) == 9
    assert spark.table(table).count() == 9


def _once(real):
    """A function that fails on its first call only."""
    calls = []

    def run(*args, **named):
        calls.append(1)
        if len(calls) == 1:
            raise Broken
        return real(*args, **named)

    return run


@pytest.mark.parametrize("buckets", [None, tables.Buckets(2)])
def test_append_checks_before_rows_are_added(spark, database, buckets, monkeypatch):
    table = f"{database}.bars"
    tables.write_table(numbers(spark, 5), table, buckets=buckets)
    with pytest.raises(Broken):
        tables.write_table(numbers(spark, 4), table, "append", buckets, accept=fail)
    assert spark.table(table).count() == 5
    real, calls = versions.rename, []

    def second_fails(*args):
        calls.append(1)
        return len(calls) < 2 and real(*args)

    monkeypatch.setattr(versions, "rename", second_fails)
    with pytest.raises(versions.CommitError):
        tables.write_table(numbers(spark, 4).repartition(3), table, "append", buckets)
    monkeypatch.undo()
    assert spark.table(table).count() == 5
    seen = {}
    assert tables.write_table(numbers(spark, 4), table, "append", buckets, {"most": F.max("id")}, seen.update) == 4
    assert spark.table(table).count() == 9 and seen == {"rows": 4, "most": 3}
    # Columns are matched by name.
    turned = numbers(spark, 2).select("trade_date", "symbol", "id")
    tables.write_table(turned, table, "append", buckets)
    assert spark.table(table).filter("symbol like 'S%'").count() == 11


def test_old_versions_go_after_the_next_but_one(spark, database):
    table = f"{database}.bars"
    for n in range(1, 6):
        tables.write_table(numbers(spark, n), table)
    root = Path(tables.table_path(spark, table).removeprefix("file:"))
    assert len([p for p in root.iterdir() if p.name != versions.LOG]) == versions.KEPT
    assert versions.current(spark, str(root)).number == 5


def test_two_writers_from_one_commit_collide(spark, tmp_path):
    root = str(tmp_path / "root")
    first = versions.commit(spark, root, {"a": "x"})
    versions.commit(spark, root, {"a": "y"}, after=first)
    with pytest.raises(versions.CommitError):
        versions.commit(spark, root, {"a": "z"}, after=first)
    assert versions.current(spark, root).folders == {"a": "y"}


LAYERS = ("landed", "staged", "metrics", "signals", "summary")


@pytest.fixture(scope="module")
def raw(spark):
    return raw_bars(spark, SMALL).filter("symbol IN ('S1', 'S2', 'S3')").coalesce(1).cache()


@pytest.mark.parametrize("step", ["metrics", "summary", "gate", "commit", "register"])
def test_layers_switch_together_or_not_at_all(spark, raw, monkeypatch, step):
    folder, name = scratch_path(spark, "layers"), f"together_{step}"
    early = raw.filter("date < '1996'")
    layers = pipeline.run_pipeline(early, name, folder)

    def seen():
        return {layer: sorted(map(str, spark.table(getattr(layers, layer)).collect())) for layer in LAYERS}

    before = seen()
    if step == "commit":
        monkeypatch.setattr(versions, "commit", fail)
    elif step == "gate":
        monkeypatch.setattr(quality, "require", fail)
    elif step == "register":
        real, calls = tables.point, []

        def third_fails(*args):
            calls.append(1)
            if len(calls) == 3:
                raise Broken
            real(*args)

        monkeypatch.setattr(tables, "point", third_fails)
    else:
        function = {"metrics": "daily_metrics", "summary": "symbol_summary"}[step]
        monkeypatch.setattr(pipeline, function, fail)
    with pytest.raises(Broken):
        pipeline.run_pipeline(raw, name, folder)
    monkeypatch.undo()
    assert seen() == before
    # Another session reads the last commit.
    for layer in ("landed", "metrics", "signals", "summary"):
        spark.sql(f"DROP TABLE {getattr(layers, layer)}")
    assert pipeline.open_layers(spark, name, folder) == layers and seen() == before


def test_landed_rows_are_scanned_once_after_landing(spark, raw, monkeypatch):
    plans = []
    real = pipeline.write_version

    def spy(df, *args, **named):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *args, **named)

    monkeypatch.setattr(pipeline, "write_version", spy)
    checks = []
    real_require = quality.require
    monkeypatch.setattr(quality, "require", lambda df, *a: (checks.append(df.inputFiles()[0]), real_require(df, *a)))
    pipeline.run_pipeline(raw, "scanned", scratch_path(spark, "run"))
    assert sum("_landing.bars__next" in plan for plan in plans) == 1
    assert all("landing" not in path for path in checks)


def test_repeated_days_are_counted_in_order(spark):
    day = date(2024, 1, 1)
    rows = [("A", day), ("A", day), ("A", day), ("A", day + timedelta(1)), ("B", day), ("B", day + timedelta(2)), ("B", day + timedelta(2)), (None, day), (None, day)]
    frame, flag = quality.with_repeats(spark.createDataFrame(rows, "symbol string, date date"), "symbol", "date")
    assert frame.agg(F.sum(flag)).first()[0] == 3
    assert quality.duplicate_keys(frame, ["symbol", "date"]).count() == 3


# The store of bars by year


def stored_rows(df, columns=m.METRIC_COLUMNS):
    return sorted(map(str, df.select(*columns).collect()))


def files_by_year(root, part):
    return {p.name: p.stat().st_mtime_ns for p in Path(root).glob(f"{part}/**/*.parquet")}


def test_refresh_equals_the_full_run_and_leaves_other_years_alone(spark, tmp_path):
    root, since = str(tmp_path / "store"), date(1998, 5, 20)
    bars = staged_bars(spark, SMALL).cache()
    store.store_bars(bars.filter(F.col("trade_date") < F.lit(since)), root)
    kept = {n: t for part in (store.BARS, store.METRICS, store.PARTS, store.COUNTS) for n, t in files_by_year(root, part).items()}
    before = versions.current(spark, root)
    changed = bars.filter(F.col("trade_date") >= F.lit(since))
    after = store.refresh(changed, since, root)
    assert stored_rows(store.read(spark, root, store.METRICS)) == stored_rows(m.daily_metrics(bars))
    assert {k: f for k, f in before.folders.items() if int(k.split("/")[1]) < 1998} == {
        k: f for k, f in after.folders.items() if int(k.split("/")[1]) < 1998
    }
    now = {n: t for part in (store.BARS, store.METRICS, store.PARTS, store.COUNTS) for n, t in files_by_year(root, part).items()}
    assert kept.items() <= now.items()
    expected = stored_rows(symbol_summary(m.daily_metrics(bars)).withColumn("avg_volatility", F.round("avg_volatility", 9)), ["*"])
    merged = store.stored_summary(spark, root)
    assert stored_rows(merged.withColumn("avg_volatility", F.round("avg_volatility", 9)), ["*"]) == expected
    assert all("/parts/" in path for path in merged.inputFiles())
    # Refreshing again replaces, and days that are gone from the new bars go.
    store.refresh(changed.filter("symbol <> 'S1' OR trade_date < '1999-01-01'"), since, root)
    assert store.read(spark, root).filter("symbol = 'S1' AND year = 1999").isEmpty()


def test_only_needed_years_are_read(spark, tmp_path):
    root, since = str(tmp_path / "store"), date(1999, 6, 1)
    days = [date(1990, 1, 1) + timedelta(days=i) for i in range(3650)]
    rows = [(s, d, x, x, x, x, 10, x) for s in ("A", "B") for i, d in enumerate(days) for x in [float(50 + i * 37 % 101)]]
    bars = spark.createDataFrame(rows, BARS)
    store.store_bars(bars, root)
    out = store.metrics_since(spark, root, since)
    read = {int(path.split("year=")[1][:4]) for path in out.inputFiles() if "/bars/" in path}
    assert read == {1998, 1999}
    assert stored_rows(out) == stored_rows(m.daily_metrics(bars).filter(F.col("trade_date") >= F.lit(since)))


def test_sparse_symbols_get_their_older_years(spark, tmp_path):
    root, since = str(tmp_path / "store"), date(1999, 1, 1)
    dense = [date(1990, 1, 1) + timedelta(days=i) for i in range(3650)]
    series = {"DENSE": dense, "SPARSE": dense[::20], "NEW": dense[3400:], "OLD": dense[:800]}
    rows = [(s, d, x, x, x, x, 10, x) for s, ds in series.items() for i, d in enumerate(ds) for x in [float(50 + i * 37 % 101)]]
    bars = spark.createDataFrame(rows, BARS)
    store.store_bars(bars, root)
    counts = store.read(spark, root, store.COUNTS)
    needed = store.warm_years(counts, spark.createDataFrame([("DENSE",), ("SPARSE",)], "symbol string"), 1999)
    assert {(r["symbol"], r["year"]) for r in needed.collect()} == {("DENSE", 1998), *(("SPARSE", y) for y in range(1990, 1999))}
    full = m.daily_metrics(bars).filter(F.col("trade_date") >= F.lit(since))
    assert stored_rows(store.metrics_since(spark, root, since)) == stored_rows(full)


def test_a_failed_refresh_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    bars = staged_bars(spark, SMALL).filter("symbol = 'S1'").cache()
    store.store_bars(bars.filter("trade_date < '1998-01-01'"), root)
    before = stored_rows(store.read(spark, root))
    monkeypatch.setattr(store, "summary_parts", fail)
    with pytest.raises(Broken):
        store.refresh(bars.filter("trade_date >= '1998-01-01'"), date(1998, 1, 1), root)
    monkeypatch.undo()
    assert stored_rows(store.read(spark, root)) == before
    assert len(list(Path(root, store.METRICS).iterdir())) == 1
    twice = bars.filter("trade_date >= '1998-01-01'")
    with pytest.raises(quality.QualityError):
        store.refresh(twice.union(twice.limit(1)), date(1998, 1, 1), root)
    with pytest.raises(ValueError):
        store.refresh(bars, date(1998, 1, 1), root)
    with pytest.raises(FileNotFoundError):
        store.read(spark, str(tmp_path / "nothing"))


def test_bars_are_made_once_and_checked_as_stored(spark, tmp_path, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    bars = staged_bars(spark, SMALL).cache()
    total = bars.count()

    def counted(rows):
        for batch in rows:
            made.add(batch.num_rows)
            yield batch

    plans, real = [], store.summary_parts
    monkeypatch.setattr(store, "summary_parts", lambda *a, **k: (plans.append(real(*a, **k)), plans[-1])[1])
    root = str(tmp_path / "store")
    store.store_bars(bars.mapInArrow(counted, bars.schema), root)
    assert made.value == total
    # Rows are combined by month before they move.
    assert "trade_date" not in re.search(r"Exchange hashpartitioning\((.*)\)", plans[0]._jdf.queryExecution().executedPlan().toString())[1]
    with pytest.raises(quality.QualityError):
        store.store_bars(bars.withColumn("trade_date", F.when(F.col("symbol") != "S1", F.col("trade_date"))), str(tmp_path / "undated"))


def test_store_from_the_command_line(spark, tmp_path, capsys):
    raw, root = raw_bars(spark, SMALL), str(tmp_path / "store")
    for name, rows in (("early", raw.filter("date < '1998-03-01'")), ("late", raw.filter("date >= '1998-03-01'"))):
        rows.write.option("header", True).csv(str(tmp_path / name))
    assert main(["store", str(tmp_path / "early"), root]) == 0
    assert main(["store", str(tmp_path / "late"), root, "--since", "1998-03-01", "--rejected", str(tmp_path / "refused")]) == 0
    assert "commit 2" in capsys.readouterr().out
    assert stored_rows(store.read(spark, root)) == stored_rows(m.daily_metrics(staged_bars(spark, SMALL)))


def test_intermediates_go_when_their_reader_is_stored(spark, tmp_path):
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with intermediates(spark):
        inner = scratch_path(spark, "inner")
        spark.range(3).write.parquet(inner)
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(inner).count()


def test_summary_parts_merge_over_nulls(make_bars):
    metrics = m.daily_metrics(make_bars([1.0, None, 0.0, 4.0] * 20).unionByName(make_bars([None] * 3, symbol="N")))
    assert stored_rows(merged_summary(summary_parts(metrics)), ["*"]) == stored_rows(symbol_summary(metrics), ["*"])
