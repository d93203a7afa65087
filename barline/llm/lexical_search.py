"""Ranked lexical search by NRA: sorted reads alone, with a lower and an upper score for every document.

Documents are stored once as the terms of the queries they hold. A task reads its part of them in shards of bounded
size and sorts each term's postings by impact. For a query it reads the lists of its terms from the top, some postings of each list a
round. What a document has collected so far is the lower end of its score; the upper end adds, for every list it has not been
met in, the impact that list goes on with. Reading stops when no document outside the candidates can reach the k-th best lower
score, no candidate that stays can change, and so the members, their ties and their scores are final. The k-th score of earlier
shards opens the next one, so most of their lists are left after the first rounds.

Impacts are whole numbers, so all bounds are exact. Each task keeps the best k documents a query; those are merged twice, by
query and salt and then by query, so that no task gets more than about the square root of all of them for one query.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barline.llm.components import stored
from barline.llm.text import alnum_words

BEST = 50
# Queries searched in one pass: bytes of their texts, and their number. What a task is sent, and returns, stays in proportion.
BLOCK_BYTES, BLOCK_QUERIES = 8 << 20, 2_000
# Postings of a shard, and cells of the table of what was met (documents times terms of the longest query).
SHARD_POSTINGS, SHARD_CELLS = 1_000_000, 32_000_000
# Postings of each list read in the first round; rounds double.
FIRST_READ = 256
# Bits of an impact within a sort key: w < 2^16 for any corpus, and a posting's factor is at most 10^6 < 2^20.
_IMPACT_BITS = 40

_HELD = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
_HELD_DDL = "doc long, n long, terms array<int>, times array<int>"
_FOUND = pa.schema([("number", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "number long, doc long, score long"

Postings = tuple[np.ndarray, np.ndarray]


def term_weight(documents: int, holding: int) -> int:
    """Weight of a term held by ``holding`` of all documents."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weight: np.ndarray, times: np.ndarray, words: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document that has it ``times`` times among its ``words``."""
    length = 100 - 50 + (50 * words * documents) // total
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * length))


def nra(lists: Sequence[Postings], size: int, best: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Documents (ordinals below ``size``) that may be among the ``best``, with their final scores.

    ``lists`` hold documents and positive impacts by falling impact. Every document of at least the ``best``-th score
    and of at least ``floor`` is returned: those tied with the last one too, none below.
    """
    lower = np.zeros(size, np.int64)
    met = np.zeros((len(lists), size), bool)
    read = [0] * len(lists)
    bars = np.array([impact[0] if len(impact) else 0 for _, impact in lists], np.int64)
    wanted: np.ndarray | None = None  # candidates, once no unmet document can join them
    step, limit = FIRST_READ, max(1, floor)
    while True:
        for i, (docs, impact) in enumerate(lists):
            if not bars[i] or (wanted is not None and met[i, wanted].all()):
                continue
            end = min(read[i] + step, len(docs))
            now, gain = docs[read[i] : end], impact[read[i] : end]
            lower[now] += gain
            met[i, now] = True
            read[i] = end
            bars[i] = impact[end] if end < len(docs) else 0
        step *= 2
        among = np.flatnonzero(lower) if wanted is None else wanted
        if len(among) >= best:
            limit = max(limit, int(np.partition(lower[among], len(among) - best)[len(among) - best]))
        if wanted is None and bars.sum() >= limit:
            continue
        upper = lower[among] + bars @ ~met[:, among]
        wanted = among[upper >= limit]
        if not len(wanted) or (upper[upper >= limit] == lower[wanted]).all():
            return wanted, lower[wanted]


class Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, parts: list[pa.RecordBatch], weight: np.ndarray, documents: int, total: int):
        table = pa.Table.from_batches(parts).combine_chunks()
        self.docs = table["doc"].to_numpy()
        self.size = len(self.docs)
        # Flattening follows the offsets, so slices give only their own postings.
        held = np.asarray(table["terms"].combine_chunks().value_lengths())
        place = np.repeat(np.arange(self.size, dtype=np.int64), held)
        terms = np.asarray(table["terms"].combine_chunks().flatten()).astype(np.int64)
        times = np.asarray(table["times"].combine_chunks().flatten()).astype(np.int64)
        impact = impacts(weight[terms], times, table["n"].to_numpy()[place], documents, total)
        some = impact > 0
        terms, place, impact = terms[some], place[some], impact[some]
        order = np.argsort((terms << _IMPACT_BITS) - impact)
        self._docs, self._impact = place[order], impact[order]
        self._starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(weight)))])

    def postings(self, term: int) -> Postings:
        part = slice(self._starts[term], self._starts[term + 1])
        return self._docs[part], self._impact[part]


def _hold(vocabulary: dict[bytes, int]):
    """The terms of the vocabulary that each document holds, and how often; documents without any term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    counts = Counter(alnum_words(text.as_py()))
                    if counts:
                        held = sorted((vocabulary[w], n) for w, n in counts.items() if w in vocabulary)
                        rows.append((doc, counts.total(), [t for t, _ in held], [n for _, n in held]))
                columns = list(zip(*rows)) or [()] * len(_HELD)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HELD)], schema=_HELD)

    return run


def _shards(batches: Iterator[pa.RecordBatch], most_documents: int) -> Iterator[list[pa.RecordBatch]]:
    """Documents in runs of bounded postings and number."""
    held: list[pa.RecordBatch] = []
    documents = postings = 0
    for batch in batches:
        for at in range(0, batch.num_rows, most_documents):
            part = batch.slice(at, most_documents)
            more = len(part.column(2).flatten())
            if held and (documents + part.num_rows > most_documents or postings + more > SHARD_POSTINGS):
                yield held
                held, documents, postings = [], 0, 0
            held.append(part)
            documents, postings = documents + part.num_rows, postings + more
    if held:
        yield held


def _search(queries: list[tuple[int, np.ndarray]], weight: np.ndarray, documents: int, total: int, best: int):
    """The best documents of a partition for each query."""
    longest = max((len(terms) for _, terms in queries), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        kept: list[Postings] = [(none, none)] * len(queries)
        for parts in _shards(batches, max(1, SHARD_CELLS // longest)):
            shard = Shard(parts, weight, documents, total)
            for i, (_, terms) in enumerate(queries):
                docs, scores = kept[i]
                floor = int(scores[-1]) if len(scores) == best else 1
                found, final = nra([shard.postings(t) for t in terms], shard.size, best, floor)
                docs, scores = np.concatenate([docs, shard.docs[found]]), np.concatenate([scores, final])
                order = np.lexsort((docs, -scores))[:best]
                kept[i] = docs[order], scores[order]
        numbers = np.repeat([number for number, _ in queries], [len(docs) for docs, _ in kept])
        if len(numbers):
            columns = [numbers, *(np.concatenate([k[j] for k in kept]) for j in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    return run


def _block(texts: DataFrame, rows: list, best: int) -> DataFrame:
    """(number, doc, score) of the best documents for a bounded block of queries."""
    words = {row["number"]: sorted(set(alnum_words(row["text"]))) for row in rows}
    vocabulary = {term: i for i, term in enumerate(sorted({t for terms in words.values() for t in terms}))}
    held = stored(texts.mapInArrow(_hold(vocabulary), _HELD_DDL), "held_terms")
    documents, total = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    # One row a term of the block, whose size is bounded.
    for term, n in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[term] = n
    weight = np.array([term_weight(documents, int(n)) for n in holding], np.int64)
    queries = [(n, np.array([vocabulary[t] for t in terms])) for n, terms in words.items() if terms]
    return held.mapInArrow(_search(queries, weight, documents, total, best), _FOUND_DDL)


def _top(found: DataFrame, best: int, *by: str) -> DataFrame:
    ranked = Window.partitionBy(*by).orderBy(F.col("score").desc(), "doc")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= best)


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    best: int = BEST,
    key: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, key, score): the ``best`` documents of each query with a score above 0, best first, equal scores by key.

    Terms are runs of ASCII letters, lower-cased, digits and anything beyond ASCII. Every row of ``docs`` with a key is a document:
    repeated rows count, and rank, each for itself; rows without a key are left out. Null and empty texts hold no term, are not
    counted and are never found. Equal query rows are one query; rows that share an id but not a text are ranked apart, a null id is
    an id like others, and queries without a term find nothing. Other columns of both tables do not matter and are not returned.

    Queries go in blocks of bounded size, each block's result stored before the next; nothing else of either table reaches the driver.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).filter("doc is not null")
    wanted = queries.select(F.col(query_id).alias("query"), F.col(query_text).alias("text")).distinct()
    asked = stored(wanted.withColumn("number", F.monotonically_increasing_id()), "queries")
    size, rows = asked.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, math.ceil((size or 0) / block_bytes), math.ceil(rows / block_queries))
    found: DataFrame | None = None
    for k in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == k).select("number", "text").collect()
        part = stored(_block(texts, block, best).withColumn("salt", F.spark_partition_id()), "found")
        salts = math.ceil(math.sqrt(max(1, part.agg(F.max("salt")).first()[0] or 0)))
        top = _top(part.withColumn("salt", F.pmod("salt", F.lit(salts))), best, "number", "salt").drop("salt", "rank")
        found = top if found is None else found.union(top)
    ranked = _top(found, best, "number").join(asked.select("number", "query"), "number")
    return ranked.select(
        F.col("query").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score"
    )
