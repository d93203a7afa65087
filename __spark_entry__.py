"""Registry of the queries and their SQL twins, all over the whole test tables.

Bars come from ``testbed.bars``: one bar per symbol and calendar day by construction. A symbol can therefore hold no more
rows than the date range has days at any scale (2,499 here); the ``_chunked`` queries cut every history nevertheless.

Most columns are compared bit for bit; ``testbed.compare`` lists those rounded first, and why.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barline.operators import quality
from barline.operators.cleaning import clean_bars, date_range, rejected_values, sort_bars, stage_bars
from barline.operators.signals import trade_signals
from barline.operators.summary import symbol_summary
from barline.plans import metrics as m, projections, store
from barline.plans.pipeline import Layers, clean_files, run_pipeline
from barline.session import scratch_path
from barline.sources import files, payloads, tables
from testbed import bars as tb, oracle as o
from testbed.compare import DIGITS, comparable

SMALL = "/root/testdata/sf0.001"

# Arguments of the registered queries.
RANGE_START, RANGE_END = date(1995, 3, 1), date(1996, 8, 31)
SINCE = date(1999, 6, 1)
REFRESH = date(1998, 9, 2)
BATCH_END = date(1995, 6, 14)
# After every bar.
LATER = date(2030, 1, 1)
FILES = 3
HEAD_SYMBOL = "S1"
EMA_COLUMNS = ("ema_12", "ema_26", "macd_ema", "macd_ema_signal", "macd_ema_histogram")
# Far below any real setting, so that every history is cut several times.
SMALL_CHUNK = 150
# Rows from which a history is cut where one symbol has most of them.
CHUNK = 4_000

Query = Callable[[SparkSession, str], DataFrame]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.daily_metrics(tb.staged_bars(spark, sf_dir), rows_per_chunk=None)


def _cut_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics with every history cut; bars are stored first, since cutting reads them several times."""
    path = scratch_path(spark, "bars")
    tb.staged_bars(spark, sf_dir).write.parquet(path)
    return m.daily_metrics(spark.read.parquet(path), SMALL_CHUNK)


def entry(spark: SparkSession) -> DataFrame:
    """Daily trading signals of the brands at the smallest scale."""
    return _signals_by_brand(spark, SMALL)


def _signals_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(trade_signals(m.daily_metrics(tb.staged_bars_by_brand(spark, sf_dir), None)))


def _slice(operator: Callable[..., DataFrame]) -> Query:
    """A single-indicator query over the staged bars."""
    return lambda spark, sf_dir: comparable(operator(tb.staged_bars(spark, sf_dir), rows_per_chunk=None))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_bars_csv(tb.landed_bars(spark, sf_dir), path)
    return files.read_bars_csv(spark, path)


def _damaged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    tb.damaged_bars(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_raw_csv(spark, path)


def _new_namespace(spark: SparkSession, name: str) -> tuple[str, str]:
    """A database name not used before, and its folder."""
    folder = scratch_path(spark, name)
    return folder.rsplit("/", 1)[-1].replace("-", "_"), folder


def _new_table(spark: SparkSession) -> str:
    database, folder = _new_namespace(spark, "landing")
    tables.ensure_database(spark, database, folder)
    return f"{database}.bars"


def _load(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    path, table = scratch_path(spark, "csv"), _new_table(spark)
    files.write_bars_csv(tb.landed_bars(spark, sf_dir), path)
    return table, tables.load_bars(spark, f"{path}/*.csv", table)


def _load_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the load reported beside the rows found in the table."""
    table, reported = _load(spark, sf_dir)
    return spark.table(table).agg(
        F.count("*").alias("loaded_rows"), F.lit(reported).cast("long").alias("reported_rows")
    )


def _append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _new_table(spark)
    early, late = _batches(spark, sf_dir)
    tables.write_table(early, table, "empty")
    tables.write_table(late, table, "append")
    return spark.table(table)


def _dq_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = tb.landed_bars(spark, sf_dir)
    layers = {
        "landing": (landed, quality.LANDED_CONSTRAINTS),
        "staging": (stage_bars(landed), quality.STAGED_CONSTRAINTS),
        "marts": (symbol_summary(_metrics(spark, sf_dir)), quality.SUMMARY_CONSTRAINTS),
    }
    return tables.union_batches(
        *(quality.check(df, rules).withColumn("layer", F.lit(name)) for name, (df, rules) in layers.items())
    )


def _chain(spark: SparkSession, sf_dir: str) -> Layers:
    return run_pipeline(tb.raw_bars(spark, sf_dir), *_new_namespace(spark, "chain"))


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """A store of all bars but the last years', refreshed with those from ``REFRESH`` on."""
    path = scratch_path(spark, "store")
    store.store_bars(tb.staged_bars(spark, sf_dir, last=REFRESH - timedelta(days=1)), path)
    store.refresh(tb.staged_bars(spark, sf_dir, first=REFRESH), REFRESH, path)
    return path


def _stored_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "store")
    store.store_bars(tb.staged_bars(spark, sf_dir), path)
    return store.metrics_since(spark, path, SINCE)


def _ingest_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guard does with all payloads, and with those that are of no use."""
    path, rows = scratch_path(spark, "sent"), []
    tb.payloads(spark, sf_dir).write.parquet(path)
    sent = spark.read.parquet(path)

    def stored(part: DataFrame) -> DataFrame:
        """The bars of payloads, which are parsed once; the guard needs no more than their symbols."""
        path = scratch_path(spark, "guarded")
        payloads.bars_from_payloads(part).select("symbol").write.parquet(path)
        return spark.read.parquet(path)

    everything = stored(sent)
    useless = sent.join(everything.distinct(), "symbol", "left_anti")
    for case, bars in (("all", everything), ("useless", stored(useless))):
        try:
            rows.append((case, False, payloads.require_data(bars).count()))
        except payloads.NoDataError:
            rows.append((case, True, 0))
    return spark.createDataFrame(rows, "payloads string, refused boolean, bars long")


def _sink_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows of sorted bars written to a given number of files, and whether files follow each other in order."""
    path = scratch_path(spark, "csv")
    files.write_bars_csv(tb.landed_bars(spark, sf_dir), path, in_order=True, files=FILES)
    read = files.read_bars_csv(spark, path).select(F.input_file_name().alias("file"), F.struct("symbol", "date").alias("key"))
    ends = read.groupBy("file").agg(F.count("*").alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
    # One row a file, of which there are few.
    before = F.lag("last").over(Window.orderBy("file"))
    placed = ends.withColumn("in_order", F.coalesce(F.col("first") > before, F.lit(True)))
    return placed.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.min("in_order").alias("in_order"))


def _clean_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether cleaning wrote a file, and how many rows, for a range with bars and one without."""
    source, rows = scratch_path(spark, "raw"), []
    tb.raw_bars(spark, sf_dir).write.option("header", True).csv(source)
    for case, first, last in (("some", RANGE_START, RANGE_END), ("none", LATER, None)):
        target = scratch_path(spark, "clean")
        written = clean_files(spark, source, target, start=first, end=last)
        rows.append((case, written, files.read_bars_csv(spark, target).count() if written else 0))
    return spark.createDataFrame(rows, "bars string, written boolean, rows long")


def _quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gate stopped good and dirty bars, and what it said."""
    rows = []
    for layer, bars in (("good", tb.staged_bars(spark, sf_dir)), ("dirty", tb.dirty_bars(spark, sf_dir))):
        try:
            quality.require(bars, quality.STAGED_CONSTRAINTS, layer)
            rows.append((layer, False, ""))
        except quality.QualityError as error:
            rows.append((layer, True, str(error)))
    return spark.createDataFrame(rows, "layer string, stopped boolean, message string")


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    early = tb.landed_bars(spark, sf_dir, last=BATCH_END)
    return early, tb.landed_bars(spark, sf_dir, first=BATCH_END + timedelta(days=1))


def _union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _batches(spark, sf_dir)
    return tables.union_batches(early, late.select(*reversed(late.columns)))


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.run_sql(
        spark,
        """SELECT year(trade_date) AS year, count(*) AS bars, count(DISTINCT symbol) AS symbols,
                  sum(volume) AS volume, max(high) AS high
           FROM {bars} GROUP BY year(trade_date)""",
        bars=tb.staged_bars(spark, sf_dir),
    )


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text-corpus subpackage, if it is there."""
    try:
        import corpus_pipeline
        from barline.llm import oracle, queries as corpus
    except ImportError:
        return {}, {}
    named = {**corpus.queries(), "pipeline": corpus_pipeline.run}
    sql = {**oracle.oracle_sql(), "pipeline": corpus_pipeline.ORACLE_SQL}
    return named, {name: text for name, text in sql.items() if text is not None}


def queries() -> dict[str, Query]:
    """One entry per operator; each takes (spark, sf_dir)."""
    return {**bar_queries(), **_corpus()[0]}


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL over the same tables, where SQL can express them."""
    return {**bar_oracle(), **_corpus()[1]}


def bar_queries() -> dict[str, Query]:
    return {
        "daily_bars": tb.landed_bars,
        "daily_bars_by_brand": tb.landed_bars_by_brand,
        # Sources and sinks
        "csv_roundtrip": _csv_roundtrip,
        "ingest_payloads": lambda s, d: payloads.bars_from_payloads(tb.payloads(s, d)),
        "ingest_quarantine": lambda s, d: payloads.quarantine(tb.payloads(s, d)),
        "ingest_guard": _ingest_guard,
        "sink_files": _sink_files,
        "symbol_coverage": lambda s, d: payloads.symbols_without_bars(
            tb.universe(s, d), tb.landed_bars(s, d)
        ),
        "union_batches": _union_batches,
        "date_range": lambda s, d: date_range(tb.landed_bars(s, d), RANGE_START, RANGE_END),
        "load_bars": lambda s, d: s.table(_load(s, d)[0]),
        "load_row_count": _load_row_count,
        "append_batches": _append_batches,
        "adhoc_sql": _adhoc,
        # Cleaning
        "clean_bars": lambda s, d: sort_bars(clean_bars(tb.raw_bars(s, d))),
        "clean_csv": lambda s, d: clean_bars(_damaged_csv(s, d)),
        "clean_rejected": lambda s, d: rejected_values(_damaged_csv(s, d)),
        "clean_ranges": _clean_ranges,
        "stage_bars": lambda s, d: stage_bars(tb.landed_bars(s, d)),
        # Indicators
        "daily_price_stats": lambda s, d: m.daily_price_stats(tb.staged_bars(s, d)),
        "daily_returns": _slice(m.daily_returns),
        "moving_averages": _slice(m.moving_averages),
        "bollinger_bands": _slice(m.bollinger_bands),
        "volatility_annualized": _slice(m.volatility_annualized),
        "gain_loss": _slice(m.gain_loss),
        "rsi_14": _slice(m.rsi),
        "macd_sma": _slice(m.macd),
        "macd_ema": lambda s, d: comparable(m.macd_ema(tb.staged_bars(s, d))),
        # Models
        "daily_metrics": lambda s, d: comparable(_metrics(s, d)),
        "daily_metrics_chunked": lambda s, d: comparable(_cut_metrics(s, d)),
        "daily_metrics_hot": lambda s, d: comparable(m.daily_metrics(tb.hot_bars(s, d), CHUNK)),
        "daily_metrics_since": lambda s, d: comparable(
            m.daily_metrics_since(tb.staged_bars(s, d), SINCE)
        ),
        "trade_signals": lambda s, d: comparable(trade_signals(_metrics(s, d))),
        "trade_signals_by_brand": _signals_by_brand,
        "trade_signals_chunked": lambda s, d: comparable(trade_signals(_cut_metrics(s, d))),
        "symbol_summary": lambda s, d: comparable(symbol_summary(_metrics(s, d))),
        "chain_signals": lambda s, d: comparable(s.table(_chain(s, d).signals)),
        "chain_summary": lambda s, d: comparable(s.table(_chain(s, d).summary)),
        # Storage by year
        "refreshed_metrics": lambda s, d: comparable(
            store.read(s, _refreshed(s, d), store.METRICS).select(*m.METRIC_COLUMNS)
        ),
        "refreshed_summary": lambda s, d: comparable(store.stored_summary(s, _refreshed(s, d))),
        "stored_metrics_since": lambda s, d: comparable(_stored_since(s, d)),
        # Quality checks, on rows that break them
        "dq_not_null": lambda s, d: quality.null_violations(tb.dirty_bars(s, d), ["symbol", "trade_date"]),
        "dq_unique_symbol": lambda s, d: quality.duplicate_keys(tb.dirty_bars(s, d), ["symbol"]),
        "dq_unique_bar": lambda s, d: quality.duplicate_keys(tb.dirty_bars(s, d), ["symbol", "trade_date"]),
        "dq_layers": _dq_layers,
        "dq_gate": _quality_gate,
        "dq_report": lambda s, d: quality.check(tb.dirty_bars(s, d), quality.STAGED_CONSTRAINTS),
        # Projections
        "symbol_head": lambda s, d: projections.symbol_head(_metrics(s, d), HEAD_SYMBOL),
        "ma_projection": lambda s, d: projections.ma_projection(_metrics(s, d)),
        "band_projection": lambda s, d: comparable(projections.band_projection(_metrics(s, d))),
    }


def bar_oracle() -> dict[str, str]:
    key = "symbol, trade_date"
    landed = o.over("landed", "select * from landed")
    signal_list = o.columns(*o.SIGNAL_COLUMNS)
    metrics = o.over("metrics", f"select {o.columns(*o.METRIC_COLUMNS)} from metrics")
    signals = o.over("signals", f"select {signal_list} from signals")
    summary = o.over("metrics", o.SUMMARY)
    nation = "(select 'S' || cast(s_suppkey as varchar) as symbol, s_nationkey as nation from supplier)"
    dirty = """with dirty as (
        select case when l_quantity <> 50 then 'S' || cast(l_suppkey as varchar) end as symbol,
               case when l_quantity <> 1 then cast(l_shipdate as date) end as trade_date
        from lineitem) """
    nulls = (
        "select 'symbol' as column_name, count(*) - count(symbol) as failures from dirty "
        "union all select 'trade_date', count(*) - count(trade_date) from dirty"
    )
    repeated = f"select {key}, count(*) as row_count from dirty group by {key} having count(*) > 1"
    gate = f"""select 'dirty' as layer, true as stopped, 'dirty: ' || string_agg(failed, '; ' order by place) as message from (
        select 1 as place, 'not_null(symbol): ' || (count(*) - count(symbol)) as failed from dirty
        union all select 2, 'not_null(trade_date): ' || (count(*) - count(trade_date)) from dirty
        union all select 3, 'unique(symbol, trade_date): ' || count(*) from ({repeated}))
        union all select 'good', false, '' """
    in_range = f"select * from landed where cast(date as date) between date '{RANGE_START}' and date '{RANGE_END}'"
    averages = "ma_20 as twenty_ma, ma_200 as two_hundred_ma"
    return {
        "daily_bars": landed,
        "daily_bars_by_brand": o.over("landed", "select * from landed", o.LANDED_BY_BRAND),
        "csv_roundtrip": landed,
        "ingest_payloads": o.over(
            "landed",
            f"""select landed.* replace (case when nation <> 8 or "divCash" = 0 then close end as close)
                from landed join {nation} using (symbol)
                where nation in (7, 8) or nation > 9 or (nation = 6 and "divCash" = 0)""",
        ),
        "ingest_quarantine": o.over(
            "landed",
            f"""select distinct symbol, case nation when 0 then 'not_json' when 1 then 'not_json'
                  when 2 then 'empty' when 3 then 'not_array' when 4 then 'missing_field'
                  when 5 then 'not_array' when 6 then 'bad_date' when 8 then 'bad_value' else 'not_json' end as reason
                from landed join {nation} using (symbol)
                where nation < 6 or nation = 9 or (nation in (6, 8) and "divCash" = 1)""",
        ),
        "ingest_guard": o.over(
            "landed",
            f"""select 'all' as payloads, false as refused, count(*) as bars from landed join {nation} using (symbol)
                where nation in (7, 8) or nation > 9 or (nation = 6 and "divCash" = 0)
                union all select 'useless', true, 0""",
        ),
        "sink_files": o.over("landed", f"select {FILES} as files, count(*) as rows, true as in_order from landed"),
        "symbol_coverage": """select 'S' || cast(c_custkey as varchar) as symbol from customer
            where c_custkey not in (select l_suppkey from lineitem)""",
        "union_batches": landed,
        "date_range": o.over(
            "landed",
            f"""select * from landed
                where cast(date as date) between date '{RANGE_START}' and date '{RANGE_END}'""",
        ),
        "load_bars": landed,
        "append_batches": landed,
        "load_row_count": o.over(
            "landed", "select count(*) as loaded_rows, count(*) as reported_rows from landed"
        ),
        "adhoc_sql": o.over(
            "staged",
            """select cast(extract(year from trade_date) as int) as year, count(*) as bars,
                 count(distinct symbol) as symbols, cast(sum(volume) as bigint) as volume, max(high) as high
               from staged group by 1""",
        ),
        "clean_bars": o.over(
            "landed",
            """select * replace (date + interval 16 hour as date,
                 case when "divCash" = 0 then "adjHigh" end as "adjHigh") from landed""",
        ),
        "clean_csv": o.over(
            "landed",
            """select * replace (case when day(date) <> 11 then date + interval 16 hour end as date,
                 case when day(date) <> 13 then volume end as volume, case when day(date) <> 5 then close end as close,
                 case when day(date) <> 7 then high end as high, case when day(date) <> 9 then low end as low,
                 case when "divCash" = 0 then "adjHigh" end as "adjHigh") from landed""",
        ),
        "clean_rejected": o.over(
            "landed",
            """select symbol, case day(date) when 11 then 'some day'
                   else strftime(date, '%Y-%m-%d') || 'T16:00:00.250Z' end as date,
                 case day(date) when 5 then 'close' when 11 then 'date' else 'volume' end as column_name,
                 case day(date) when 5 then 'abc' when 11 then 'some day' else cast(volume as varchar) || '.5' end as value,
                 case day(date) when 11 then 'bad_date' else 'bad_value' end as reason
               from landed where day(date) in (5, 11, 13)""",
        ),
        "clean_ranges": o.over(
            "landed",
            f"select 'some' as bars, true as written, count(*) as rows from ({in_range}) union all select 'none', false, 0",
        ),
        "stage_bars": o.over("staged", "select * from staged"),
        "daily_price_stats": o.over(
            "metrics",
            f"""select {key}, daily_change, daily_range, daily_value_traded,
                {o.columns('daily_change_pct', 'daily_volatility_pct')} from metrics""",
        ),
        "daily_returns": o.over(
            "derived", f"select {key}, {o.columns('daily_pct_change', 'daily_log_return')} from derived"
        ),
        "moving_averages": o.over("steps", f"select {key}, {o.columns('ma_20', 'ma_50', 'ma_200')} from steps"),
        "bollinger_bands": o.over(
            "derived", f"select {key}, {o.columns('stddev_20', 'bollinger_upper', 'bollinger_lower')} from derived"
        ),
        "volatility_annualized": o.over("metrics", f"select {key}, {o.columns('volatility_annualized')} from metrics"),
        "gain_loss": o.over("derived", f"select {key}, gain, loss from derived"),
        "rsi_14": o.over("metrics", f"select {key}, {o.columns('rsi_14')} from metrics"),
        "macd_sma": o.over("metrics", f"select {key}, {o.columns('macd_approx', 'macd_signal_approx')} from metrics"),
        "macd_ema": o.over("staged", o.MACD_EMA + f" select {key}, {o.columns(*EMA_COLUMNS)} from averages"),
        "daily_metrics": metrics,
        "daily_metrics_chunked": metrics,
        "daily_metrics_hot": o.over("metrics", f"select {o.columns(*o.METRIC_COLUMNS)} from metrics", o.LANDED_HOT),
        "daily_metrics_since": f"{metrics} where trade_date >= date '{SINCE}'",
        "trade_signals": signals,
        "trade_signals_by_brand": o.over("signals", f"select {signal_list} from signals", o.LANDED_BY_BRAND),
        "trade_signals_chunked": signals,
        "symbol_summary": summary,
        "chain_signals": signals,
        "chain_summary": summary,
        "refreshed_metrics": metrics,
        "refreshed_summary": summary,
        "stored_metrics_since": f"{metrics} where trade_date >= date '{SINCE}'",
        "dq_not_null": dirty + nulls,
        "dq_unique_symbol": dirty
        + """select symbol, count(*) as row_count from dirty
             where symbol is not null group by symbol having count(*) > 1""",
        "dq_unique_bar": dirty + repeated,
        "dq_layers": o.over(
            "metrics",
            f"""select 'landing' as layer, 'not_null' as check_name, 'symbol' as column_name,
                  count(*) - count(symbol) as failures from landed
                union all select 'landing', 'not_null', 'date', count(*) - count(date) from landed
                union all select 'staging', 'not_null', 'symbol', count(*) - count(symbol) from staged
                union all select 'staging', 'not_null', 'trade_date', count(*) - count(trade_date) from staged
                union all select 'staging', 'unique', 'symbol, trade_date', count(*)
                  from (select {key} from staged group by {key} having count(*) > 1)
                union all select 'marts', 'not_null', 'symbol', count(*) - count(symbol) from ({o.SUMMARY})
                union all select 'marts', 'unique', 'symbol', count(*)
                  from (select symbol from ({o.SUMMARY}) group by symbol having count(*) > 1)""",
        ),
        "dq_gate": dirty + gate,
        "dq_report": dirty
        + f"""select 'not_null' as check_name, column_name, failures from ({nulls})
              union all select 'unique', 'symbol, trade_date', count(*) from ({repeated})""",
        "symbol_head": o.over(
            "metrics",
            f"""select trade_date as date, symbol as ticker, {averages}
                from metrics where symbol = '{HEAD_SYMBOL}' order by trade_date limit 10""",
        ),
        "ma_projection": o.over("metrics", f"select trade_date as date, symbol as ticker, {averages} from metrics"),
        "band_projection": o.over(
            "metrics",
            f"""select symbol as ticker, round(bollinger_upper, {DIGITS['bolinger_up']}) as bolinger_up,
                  round(bollinger_lower, {DIGITS['bolinger_down']}) as bolinger_down from metrics""",
        ),
    }
