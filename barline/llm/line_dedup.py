"""Line deduplication by hashes: keep bitmaps per document instead of rewritten texts.

A line's key is the line stripped of ASCII white space with A-Z lower-cased. Each document's distinct keys
become (hash, document, position) rows. They are counted per hash and *salt* (a share of the
documents) first, which leaves at most one row a salt of the hottest line. Those rows are partitioned
by ranges of the hash and sorted by hash, document and position; a window over each run of equal
hashes streams the first occurrence and the number of documents. Lines then meet their verdict by hash and
salt, so a line that a third of all documents have is spread over all salts. Counting and verdict share one shuffle of the rows. Hashes
are 128 bits wide. A document's bitmap consists of 64-bit words, of which only those with a dropped
line are stored.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barline.llm.components import stored
from barline.llm.text import BLANKS, ascii_lower, fresh

MIN_DOCUMENTS = 10
MIN_CODE_POINTS = 1
_BITS = 64
# Bitmaps that may be broadcast, by their size in memory: so much a document and a word.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES, _WORD_BYTES = 96, 32


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def strip(line: Column) -> Column:
    """A line without ASCII white space at its ends."""
    return F.btrim(line, F.lit(BLANKS))


def keep_bitmaps(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_code_points: int = MIN_CODE_POINTS,
    keep_first: bool = False,
) -> DataFrame:
    """Bitmaps of the lines to keep, for the documents that lose any: (key, text_hash, keep).

    A key of at least ``min_code_points`` code points in at least ``min_documents`` documents is repeated: it loses
    all its lines, or with ``keep_first`` all but the first by document and position. ``keep`` lists
    (word, bits) in order: line ``i`` stays if word ``i div 64`` is absent or its bit ``i % 64`` is set.
    Rows of one id with different texts count as one document and are told apart by ``text_hash``;
    repeated rows share a bitmap. A null id is an id of its own. Empty tables give no rows.
    """
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("text_hash"), lines_of(F.col(text)).alias("lines"))
    lines = texts.select("doc", "text_hash", F.posexplode_outer("lines").alias("pos", "line"))
    # Lower-casing keeps the length, so short keys go before they are lower-cased.
    stripped = lines.withColumn("line", strip(F.col("line"))).filter(F.char_length("line") >= min_code_points)
    hashed = (
        stripped.select(
            # Known not to be null, so that no filter tells the two uses of this shuffle apart.
            F.coalesce(F.unhex(F.md5(ascii_lower(F.col("line")))), F.lit(b"")).alias("hash"),
            F.coalesce(F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"), F.lit(0)).alias("salt"),
            "doc",
            "text_hash",
            "pos",
        ).repartition("hash", "salt")
    )

    # Neither count shuffles again: one row a document and key, then one a salt.
    order = F.struct("doc", "pos", "text_hash")
    once = hashed.groupBy("hash", "salt", "doc").agg(F.min(order).alias("first"))
    shares = once.groupBy("hash", "salt").agg(F.count("*").alias("documents"), F.min("first").alias("first"))
    # Ranges of hashes, in them the order of documents and positions.
    ranges = shares.repartitionByRange(salts, "hash")
    stream = Window.partitionBy("hash").orderBy("first").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    repeated = (
        ranges.withColumn("documents", F.sum("documents").over(stream))
        .withColumn("first", F.first("first").over(stream))
        .filter(F.col("documents") >= min_documents)
        .select("hash", "salt", "first")
    )
    dropped = hashed.join(repeated, ["hash", "salt"])
    if keep_first:
        dropped = dropped.filter(~order.eqNullSafe(F.col("first")))
    word, bit = F.floor(F.col("pos") / _BITS).cast("int"), (F.col("pos") % _BITS).cast("int")
    words = dropped.groupBy("doc", "text_hash", word.alias("word")).agg(
        F.bitwise_not(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit))).alias("bits")
    )
    keep = F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep")
    return words.groupBy(F.col("doc").alias(key), "text_hash").agg(keep)


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps; all of them without a bitmap."""

    def part(word: Column) -> Column:
        own = F.slice(lines, word * _BITS + 1, _BITS)
        bits = F.element_at(F.map_from_entries(keep), word)
        chosen = F.filter(own, lambda _, i: F.call_function("getbit", bits, i) == 1)
        return F.when(bits.isNull(), own).otherwise(chosen)

    words = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / _BITS).cast("int"))
    return F.when(keep.isNull(), lines).otherwise(F.flatten(F.transform(words, part)))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text", into: str = "lines"
) -> DataFrame:
    """``docs`` with a struct of the ``kept`` text, ``n_lines`` before and ``n_dropped``.

    One join by id and text. Bitmaps are stored and measured first: up to ``BROADCAST_BYTES`` they go to
    the texts, beyond that both are shuffled. Rows keep their other columns and their number; a column named as ``into``
    is replaced.
    """
    doc, text_hash, words, split = fresh("doc"), fresh("text_hash"), fresh("keep"), fresh("lines")
    found = stored(bitmaps.select(F.col(key).alias(doc), F.col("text_hash").alias(text_hash), F.col("keep").alias(words)), "bitmaps")
    size = found.agg(F.sum(_ROW_BYTES + F.size(words) * _WORD_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    same = F.col(key).eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(text)) == F.col(text_hash))
    joined = docs.join(found, same, "left").drop(doc, text_hash).withColumn(split, lines_of(F.col(text)))
    lines, keep = F.col(split), F.col(words)
    gone = F.aggregate(keep, F.lit(0), lambda n, w: n + F.bit_count(F.bitwise_not(w["bits"])))
    result = F.struct(
        F.when(keep.isNull(), F.coalesce(F.col(text), F.lit("")))
        .otherwise(F.array_join(kept_lines(lines, keep), "\n"))
        .alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"),
    )
    return joined.withColumn(into, result).drop(words, split)
