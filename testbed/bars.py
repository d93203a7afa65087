"""Price bars from the ``lineitem`` table.

A line item is one trade: supplier (or brand) = symbol, ship date = day, whole-number extended
price = price, quantity = volume. Trades of a day are ordered by order key, line number, price.
Whole-number prices and an adjustment factor of one half keep sums exact in binary floating
point, so results do not depend on the order in which an engine adds them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barline.schema import LANDED, RAW, STAGED_FROM_LANDED

# The day of the two-for-one split, and the day of month dividends are paid.
SPLIT_DAY = date(1998, 1, 1)
DIVIDEND_DAY = 15

# Prices are below this and line numbers below ten, see ``_trades``.
_PRICE_SPACE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_symbol(column: str) -> Column:
    return F.concat(F.lit("S"), F.col(column).cast("string"))


def _trades(lineitem: DataFrame, symbol: Column) -> DataFrame:
    """symbol, trade_date, price, quantity, and ``placed``: the trade's order with its price.

    Packing order and price into one number lets first and last price be a plain min and max,
    which aggregate by hashing; a struct would force a sort of all trades. Under ANSI a value
    beyond 64 bits raises instead of wrapping.
    """
    price = F.floor("l_extendedprice").cast("long")
    return lineitem.select(
        symbol.alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        price.alias("price"),
        F.col("l_quantity").alias("quantity"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * _PRICE_SPACE + price).alias("placed"),
    )


def _daily(trades: DataFrame) -> DataFrame:
    """One bar per symbol and day. Trades are combined before the shuffle, so a symbol with a
    large share of them still moves as one row per day and input partition."""

    def price_of(placed: Column) -> Column:
        return (placed % _PRICE_SPACE).cast("double")

    return trades.groupBy("symbol", "trade_date").agg(
        price_of(F.min("placed")).alias("open"),
        F.max("price").cast("double").alias("high"),
        F.min("price").cast("double").alias("low"),
        price_of(F.max("placed")).alias("close"),
        F.sum("quantity").cast("long").alias("volume"),
    )


def _adjusted(daily: DataFrame) -> DataFrame:
    """Staged bars: prices halved and volumes doubled before the split."""
    before_split = F.col("trade_date") < F.lit(SPLIT_DAY)
    factor = F.when(before_split, 0.5).otherwise(1.0)
    return daily.withColumns(
        {
            **{f"adj_{name}": F.col(name) * factor for name in ("open", "high", "low", "close")},
            "adj_volume": F.when(before_split, F.col("volume") * 2).otherwise(F.col("volume")),
            "dividend_cash": F.when(F.day("trade_date") == DIVIDEND_DAY, 1.0).otherwise(0.0),
            "split_factor": F.when(F.col("trade_date") == F.lit(SPLIT_DAY), 2.0).otherwise(1.0),
        }
    ).select(*STAGED_FROM_LANDED)


def _landed(staged: DataFrame) -> DataFrame:
    """The landed bars that staging would turn into these."""
    names = {landed: staged for staged, landed in STAGED_FROM_LANDED.items()}
    day = F.col("trade_date").cast("timestamp_ntz")
    return staged.select(
        *((day if name == "date" else F.col(names[name])).alias(name) for name in LANDED.names)
    )


def staged_bars(
    spark: SparkSession, sf_dir: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Bars by supplier; their number grows with the table. No join is needed.

    ``first`` and ``last`` restrict the trades read, both days included.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    if first:
        lineitem = lineitem.filter(F.col("l_shipdate") >= F.lit(first.isoformat()).cast("timestamp_ntz"))
    if last:
        end = F.lit(last.isoformat()).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(1))
        lineitem = lineitem.filter(F.col("l_shipdate") < end)
    return _adjusted(_daily(_trades(lineitem, supplier_symbol("l_suppkey"))))


# Suppliers that share a hot symbol, one in how many of them does, and the days set aside for each.
HOT_SPAN, HOT_SHARE, HOT_DAYS = 900, 3, 2600


def hot_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of which a third belong to a few symbols with long histories: those of many suppliers, one after the other."""
    number = F.substring("symbol", 2, 9).cast("int")
    offset = F.floor((number % HOT_SPAN) / HOT_SHARE).cast("int") * HOT_DAYS
    hot = number % HOT_SHARE == 0
    name = F.concat(F.lit("HOT"), F.floor(number / HOT_SPAN).cast("string"))
    return staged_bars(spark, sf_dir).withColumns(
        {
            "symbol": F.when(hot, name).otherwise(F.col("symbol")),
            "trade_date": F.when(hot, F.date_add("trade_date", offset)).otherwise(F.col("trade_date")),
        }
    )


def staged_bars_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the 25 brands. Spark broadcasts the part table only while it is small."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return _adjusted(_daily(_trades(joined, F.col("p_brand"))))


def landed_bars(
    spark: SparkSession, sf_dir: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """``staged_bars`` in the layout they would have been loaded with."""
    return _landed(staged_bars(spark, sf_dir, first, last))


def landed_bars_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(staged_bars_by_brand(spark, sf_dir))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a source sends them: all text, date with time and zone mark, NaN for a missing value."""
    landed = landed_bars(spark, sf_dir)
    text = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T16:00:00.250Z"))
    missing = F.when(F.col("divCash") > 0, "NaN").otherwise(F.col("adjHigh").cast("string"))
    others = (F.col(name).cast("string").alias(name) for name in RAW.names if name not in ("date", "adjHigh"))
    return landed.select(*others, text.alias("date"), missing.alias("adjHigh")).select(*RAW.names)


def damaged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars with cells spoilt by the day of the month: a whole number written as ``11.0`` (day 3), a word for a
    price (5), an empty price (7), NaN (9), an unreadable date (11) and a fractional volume (13)."""
    day = F.dayofmonth(F.substring("date", 1, 10).cast("date"))
    spoilt = {
        "volume": F.when(day == 3, F.concat("volume", F.lit(".0"))).when(day == 13, F.concat("volume", F.lit(".5"))),
        "close": F.when(day == 5, "abc"),
        "high": F.when(day == 7, ""),
        "low": F.when(day == 9, "NaN"),
        "date": F.when(day == 11, "some day"),
    }
    raw = raw_bars(spark, sf_dir)
    return raw.select(*(F.coalesce(spoilt[c], F.col(c)).alias(c) if c in spoilt else F.col(c) for c in raw.columns))


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged-layout bars that were never combined per day: one row per trade, so days repeat.

    The date is missing on trades of one unit, the symbol on trades of fifty units.
    """
    trades = _trades(table(spark, sf_dir, "lineitem"), supplier_symbol("l_suppkey"))
    return trades.select(
        F.when(F.col("quantity") != 50, F.col("symbol")).alias("symbol"),
        F.when(F.col("quantity") != 1, F.col("trade_date")).alias("trade_date"),
        F.col("price").cast("double").alias("close"),
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols numbered as the customers are, most of which no supplier's bars bear."""
    return table(spark, sf_dir, "customer").select(supplier_symbol("c_custkey").alias("symbol"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per supplier; each of the first ten nations has a way of its own.

    A payload holds one record per trading day, so its size is bounded by the date range.
    """
    nation = table(spark, sf_dir, "supplier").select(
        supplier_symbol("s_suppkey").alias("symbol"), F.col("s_nationkey").alias("nation")
    )
    day = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    bars = landed_bars(spark, sf_dir).join(nation, "symbol").withColumn("date", day)
    # Nation 4 leaves out the volume, nation 6 has an unreadable date on dividend days, nation 7 writes whole
    # numbers with a fraction, nation 8 has a word for the price on dividend days.
    bars = bars.withColumn(
        "date", F.when((F.col("nation") == 6) & (F.col("divCash") > 0), "soon").otherwise(F.col("date"))
    )
    fields = [name for name in LANDED.names if name != "symbol"]
    options = {"ignoreNullFields": "false"}

    def record_with(**changed: Column) -> Column:
        return F.to_json(F.struct(*(changed[f].alias(f) if f in changed else F.col(f) for f in fields)), options)

    word = F.when(F.col("divCash") > 0, "abc").otherwise(F.col("close").cast("string"))
    record = (
        F.when(F.col("nation") == 4, F.to_json(F.struct(*(f for f in fields if f != "volume")), options))
        .when(F.col("nation") == 7, record_with(volume=F.col("volume").cast("double")))
        .when(F.col("nation") == 8, record_with(close=word))
        .otherwise(record_with())
    )
    body = F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]"))
    sent = bars.groupBy("symbol", "nation").agg(body.alias("body"))
    broken = (
        F.when(F.col("nation") == 0, "not json")
        .when(F.col("nation") == 1, F.lit(None).cast(T.StringType()))
        .when(F.col("nation") == 2, "[]")
        .when(F.col("nation") == 3, '{"detail":"x"}')
        .when(F.col("nation") == 5, F.concat(F.expr("left(body, length(body) - 1)"), F.lit(",7]")))
        .when(F.col("nation") == 9, F.concat("body", F.lit(" and so on")))
        .otherwise(F.col("body"))
    )
    return sent.select("symbol", broken.alias("payload"))
