"""Near-duplicate documents: banded MinHash candidates, odd sketches, confirmation on full sets.

A document's set is that of its shingles (hashes of five consecutive words, A-Z lower-cased). Equal
sets collapse to one class first. Each class gets ``SAMPLES`` MinHash values. Bands of ``ROWS``
values put similar classes into common buckets, and an odd sketch folds all samples into a bitmap of parities:

    similarity ~ 1 + bits / (4 samples) * ln(1 - 2 popcount(a xor b) / bits)

which discards what a bucket brought together by chance without touching the sets, and a pair at the
similarity with no greater chance than that of sharing no bucket. The rest is confirmed on the full sets. Links are found in two rounds, so that a group of n near copies
needs about n confirmations and not one for each pair:

1. every class against the most similar hub of its buckets; a bucket's hub is the member that meets most others
   in all its buckets, as the origin of a group of copies does;
2. within buckets that still hold several components, pairs across components. Sketches tell which members
   are needed, then their sets are brought together and links are confirmed on the spot, none within a component that
   earlier ones have joined. So rows grow with the members of a bucket even if its pairs are many.

A pair is looked at in the first bucket it shares. Large buckets of the second round are compared in blocks, so no
task holds more than two of them.
With the defaults two sets of similarity 0.8 miss all common buckets with a chance below 3e-6,
of 0.85 below 3e-9.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.components import connected, stored
from barline.llm.text import lower_spaced_words

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 6
BANDS = 42
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
# Members of a bucket compared at once in the second round, and bytes of their sets.
BLOCK = 1_000
BLOCK_BYTES = 24 << 20
# Ids that a broadcast may hold; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_MASK = (1 << 64) - 1
_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) & _MASK for i in range(SHINGLE)], dtype=np.uint64)
_RNG = np.random.default_rng(20)
_MULTIPLY = _RNG.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
# Shingles hashed at once.
_CHUNK = 200_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, memory: int = 100_000):
        self._known: dict[bytes, int] = {}
        self._memory = memory

    def __call__(self, text: str | None) -> np.ndarray:
        words = lower_spaced_words(text)
        if not words:
            return np.empty(0, np.uint64)
        known = self._known
        if len(known) > self._memory:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(words))
        n = len(words) - width + 1
        total = np.full(n, width, np.uint64)
        for k in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + _mixed(hashes[k : k + n] + _ODD[k])
        return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of nonempty sets, one row each."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for i in range(SAMPLES):
        # The product's low bits are weak: its high half, offset by the sample, is what is compared.
        out[:, i] = np.minimum.reduceat((joined * _MULTIPLY[i] + _ADD[i]) >> np.uint64(16), starts)
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    """One hash for each band of ``ROWS`` values."""
    bands = values.reshape(len(values), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(ROWS):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return total.view(np.int64)


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the (sample, value) pairs, as 64-bit words."""
    places = _mixed(values + _mixed(np.arange(SAMPLES, dtype=np.uint64))) % np.uint64(SKETCH_BITS)
    odd = np.zeros((len(values), SKETCH_BITS), np.uint8)
    np.add.at(odd, (np.arange(len(values))[:, None], places.astype(np.int64)), 1)
    return np.packbits(odd & 1, axis=1).view(np.int64)


def _band_loss(similarity: float) -> float:
    """Chance that a pair of the similarity shares no bucket."""
    return (1 - similarity**ROWS) ** BANDS


@lru_cache(maxsize=8)
def _differing_chances(similarity: float) -> np.ndarray:
    """Chance of each number of differing sketch bits for a pair of the similarity.

    Differing samples are binomial; each turns two random bits, and two that hit one bit cancel out.
    """
    out, odd = np.zeros(SKETCH_BITS + 1), np.zeros(SKETCH_BITS + 1)
    odd[0] = 1.0
    up, down = 1 - np.arange(SKETCH_BITS) / SKETCH_BITS, np.arange(1, SKETCH_BITS + 1) / SKETCH_BITS
    for differing in range(SAMPLES + 1):
        out += math.comb(SAMPLES, differing) * (1 - similarity) ** differing * similarity ** (SAMPLES - differing) * odd
        for _ in range(2):
            turned = np.zeros(SKETCH_BITS + 1)
            turned[1:] += odd[:-1] * up
            turned[:-1] += odd[1:] * down
            odd = turned
    return out


def _sketch_loss(similarity: float, most: int) -> float:
    """Chance that a pair of the similarity differs in more than ``most`` sketch bits."""
    return float(_differing_chances(similarity)[most + 1 :].sum())


def _most_differing(similarity: float) -> int:
    """The fewest differing sketch bits beyond which a pair of the similarity lies no more often than outside all buckets."""
    beyond = np.cumsum(_differing_chances(similarity)[::-1])[::-1]
    return int(np.argmax(np.append(beyond[1:], 0.0) <= _band_loss(similarity)))


_PROFILE = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest, band hashes and sketch of each document's set."""
    shingler = Shingler()

    def settled(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        sketch: list = [None] * len(sets)
        if full:
            values = signatures([sets[i] for i in full])
            for i, b, s in zip(full, band_hashes(values), odd_sketches(values)):
                bands[i], sketch[i] = b, s
        columns = (ids, [len(s) for s in sets], map(_digest, sets), bands, sketch)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PROFILE)], schema=_PROFILE)

    for batch in batches:
        ids, sets, size = [], [], 0
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(i)
            sets.append(shingler(text.as_py()))
            size += len(sets[-1])
            if size >= _CHUNK:
                yield settled(ids, sets)
                ids, sets, size = [], [], 0
        yield settled(ids, sets)


_SET = pa.schema([("set_key", pa.binary()), ("shingles", pa.binary())])


def _digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full sets, for the documents that are to be confirmed."""
    shingler = Shingler()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            found = [shingler(t.as_py()) for t in batch.column(1).slice(at, 256)]
            columns = [pa.array(map(_digest, found), pa.binary()), pa.array((s.tobytes() for s in found), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SET)


def _sets_of(wanted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, shingles) of the classes in ``wanted`` (id); only their texts are shingled again."""
    wanted = stored(wanted.distinct(), "wanted")
    chosen = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    found = texts.join(chosen, "id", "left_semi").select("id", "text").mapInArrow(_sets, "set_key binary, shingles binary")
    # A key that repeats with other texts has other sets too: those of the classes count.
    own = stored(found, "sets").dropDuplicates(["set_key"])
    return own.join(classes.select("id", "set_key"), "set_key").select("id", "shingles")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of which the full sets are similar enough.

    Each ``b`` brings its set to its ``a``; hot keys of that join are split by adaptive execution.
    """
    pairs = stored(pairs, "pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), classes, texts)
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a")), "a")
    percent = round(100 * similarity)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = ((np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(i)) for i in (2, 3))
            keep = [_linked(a, b, percent) for a, b in zip(of_a, of_b)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long")


def _differing() -> Column:
    words = F.zip_with("own.sketch", "other.sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(words, F.lit(0), lambda n, x: n + x)


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, id, hub) of the buckets with several members."""
    buckets = classes.select("id", F.explode("bands").alias("bucket")).distinct()
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(buckets.join(sizes, "bucket"), "shared")
    meetings = shared.groupBy("id").agg(F.sum("size").alias("met"))
    hubs = shared.join(meetings, "id").groupBy("bucket").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("hub"))
    return stored(shared.join(hubs, "bucket").select("bucket", "id", "hub"), "members")


def _first_round(members: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Each class with the most similar hub of its buckets, as sketches see it."""
    stars = members.filter("id <> hub").select("id", "hub").distinct()
    profile = F.struct("n", "sketch")
    pairs = stars.join(classes.select("id", profile.alias("own")), "id").join(
        classes.select(F.col("id").alias("hub"), profile.alias("other")), "hub"
    )
    sizes = F.least("own.n", "other.n") >= F.greatest("own.n", "other.n") * (similarity - 1e-9)
    close = pairs.filter(sizes).withColumn("differing", _differing()).filter(F.col("differing") <= _most_differing(similarity))
    # Nearly equal distances count as equal, so that copies of one text choose one hub.
    best = F.min_by("hub", F.struct(F.floor(F.col("differing") / 32).alias("far"), "hub"))
    return close.groupBy("id").agg(best.alias("a")).select("a", F.col("id").alias("b"))


class _Block:
    """Members of one or two blocks of a bucket, and the pairs across components that may be links."""

    def __init__(self, key: tuple, table: pa.Table, similarity: float):
        self.bucket, self.low, self.high = (k.as_py() for k in key)
        self.ids, self.components = table.column("id").to_numpy(), table.column("component").to_numpy()
        self._block, self._sizes = table.column("block").to_numpy(), table.column("n").to_numpy()

        def matrix(name: str) -> np.ndarray:
            return table.column(name).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

        self._sketches, self._bands = matrix("sketch").view(np.uint64), matrix("bands")
        self._most, self._least = _most_differing(similarity), similarity - 1e-9

    def pairs(self, component: Callable[[int], int]) -> Iterator[tuple[int, int]]:
        """Places of the members of each pair; ``component`` gives a member's component by now."""
        left, right = np.flatnonzero(self._block == self.low), np.flatnonzero(self._block == self.high)
        for i in left:
            others = right[self.ids[right] > self.ids[i]] if self.low == self.high else right
            others = others[self.components[others] != self.components[i]]
            small, large = np.minimum(self._sizes[others], self._sizes[i]), np.maximum(self._sizes[others], self._sizes[i])
            others = others[small >= large * self._least]
            differing = np.bitwise_count(self._sketches[others] ^ self._sketches[i]).sum(axis=1)
            order = np.argsort(differing, kind="stable")
            others = others[order[differing[order] <= self._most]]
            # Bucket hashes contain the number of their band, so the first equal ones are the first shared bucket.
            first = (self._bands[others] == self._bands[i]).argmax(axis=1)
            others = others[self._bands[i][first] == self.bucket]
            for j in others:
                if component(i) != component(j):
                    yield int(i), int(j)


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_NEEDED = pa.schema([("bucket", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("id", pa.int64())])


def _second_round(
    members: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, similarity: float
) -> DataFrame:
    """Links (a, b) between different components that share a bucket, enough of them to join what is linked."""
    known = members.select("bucket", "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    spread = known.groupBy("bucket").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    rows = known.join(spread.filter("first < last").select("bucket"), "bucket").join(
        classes.select("id", "n", "sketch", "bands"), "id"
    )
    size = rows.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    # Each member meets every block of its bucket: as the one that is looked up, or as the one compared.
    placed = rows.join(size, "bucket").withColumn("block", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
    cells = stored(
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "bucket",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "id",
            "component",
            "n",
            "sketch",
            "bands",
        ),
        "cells",
    )

    def need(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(key, table, similarity)
        places = {k for pair in block.pairs(lambda i: int(block.components[i])) for k in pair}
        found = sorted(int(block.ids[k]) for k in places)
        columns = [[value] * len(found) for value in (block.bucket, block.low, block.high)] + [found]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _NEEDED)], schema=_NEEDED)

    cell = ["bucket", "low", "high"]
    needed = stored(cells.groupBy(*cell).applyInArrow(need, "bucket long, low int, high int, id long"), "needed")
    sets = _sets_of(needed.select("id"), classes, texts)
    percent = round(100 * similarity)

    def link(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(key, table, similarity)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        joined: dict[int, int] = {}

        def component(i: int) -> int:
            at = int(block.components[i])
            while at in joined:
                at = joined[at]
            return at

        links = []
        for i, j in block.pairs(component):
            if _linked(sets[i], sets[j], percent):
                links.append(sorted((int(block.ids[i]), int(block.ids[j]))))
                joined[component(i)] = component(j)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*links) if links else ((), ()))], schema=_LINK)

    return cells.join(needed, [*cell, "id"]).join(sets, "id").groupBy(*cell).applyInArrow(link, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Every document with its set's size and its component: (key, n_shingles, component_id).

    Documents are linked if ``100 * intersection >= 100 * similarity * union`` (the percentage
    rounded to an integer) of their sets; ``component_id`` is the smallest key that links reach. A document of fewer than five
    words has its whole sequence as one shingle; null and empty texts have no shingle and no link.
    Keys are integers. Rows that repeat a key are one document, of different texts the one whose set has the greatest
    digest; a null key is one without links. Intermediate tables go to the shared folder.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    fields = "id long, n long, set_key binary, bands array<long>, sketch array<long>"
    profiles = stored(texts.mapInArrow(_profiles, fields), "profiles")
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = profiles.groupBy("id").agg(F.max(F.struct("set_key", "n")).alias("own")).select("id", "own.*")
    one = one.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))

    # One class for each set, named by its smallest key; a set that many have is counted by salt first.
    shares = one.filter("set_key is not null and id is not null").groupBy("set_key", "salt").agg(F.min("id").alias("id"))
    named = shares.groupBy("set_key").agg(F.min("id").alias("id"))
    classes = stored(profiles.join(named, ["set_key", "id"]).dropDuplicates(["id"]), "classes")

    members = _members(classes)
    first = stored(_confirmed(_first_round(members, classes, similarity), classes, texts, similarity), "links")
    second = _second_round(members, classes, connected(first), texts, similarity)
    labels = connected(first.unionByName(second))

    # Back to all documents by set and salt, so copies of one set are spread over the salts.
    found = classes.select("id", "set_key").join(labels, "id", "left")
    component = found.select("set_key", F.coalesce("component", "id").alias("component"))
    by_salt = shares.select("set_key", "salt").join(component, "set_key")
    return one.join(by_salt, ["set_key", "salt"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
