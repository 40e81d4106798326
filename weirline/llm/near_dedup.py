"""Near-duplicate removal with the SimHash operator's BK-trees, for similarity thresholds beyond a few bits.

A text is taken as its set of five-word shingles; texts of equal sets are one node from the start. A node's
fingerprint is a SimHash of BITS bits, in which a Hamming distance d estimates the angle between two sets, and
so their Jaccard similarity. Shards are the nodes that share a band of min-hashes: BANDS bands of BAND_ROWS
each meet 99.997% of pairs at 0.8 and more above. Each shard's BK-tree is queried within a radius that is
REACH standard errors wider than the threshold, following only edges in reach. Pairs SURE standard errors
inside it link as they are. The nodes of other pairs are dealt to their shards once more, with their shingle
sets, and pairs that nothing links yet are compared exactly. Shards of more than BLOCK nodes or BLOCK_ITEMS
shingles are dealt as pairs of blocks, so that no task holds more than two blocks. A shard gives a spanning
forest of its links, never its pairs; of every component the row with the smallest id stays.

Defined results: null text counts as empty, and empty texts are one group; fewer words than a shingle: the
whole sequence; identical rows are one group; a null id sorts last; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, lookup, map_arrow, materialize, release
from ._components import components
from .exact_dedup import HitFilter
from .simhash import CHUNK, FANOUT, BKTree, Forest, bit_counts

WORDS, SIMILARITY = 5, 0.8
BITS, BANDS, BAND_ROWS = 1024, 20, 4
#: Standard errors of the distance at the threshold: those that the search goes beyond it (one pair in a billion lies
#: further), and those within it that need no comparison of sets.
REACH, SURE = 6.0, 4.5
#: Sets smaller than this are always compared; in their fingerprints ties are common, so the search for a pair that has one goes
#: further.
SMALL, SMALL_REACH = 64, 10.0
#: Nodes, and shingles of their sets, of a block of a large shard.
BLOCK, BLOCK_ITEMS = 2048, 1 << 22
#: Multipliers of the min-hashes and of the fingerprint's further words: fixed by a seeded generator.
_ODD = np.random.Generator(np.random.PCG64(42)).integers(0, 1 << 63, BANDS * BAND_ROWS + BITS // 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distance_at(similarity: float, errors: float = 0.0, bits: int = BITS) -> int:
    """The expected distance of two sets of this similarity, plus so many of its standard errors."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * p + errors * math.sqrt(bits * p * (1 - p)))


def _mixed(h: np.ndarray, odd: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * odd
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(tokens[i : i + words]), 42) for i in range(max(1, len(tokens) - words + 1))], dtype=np.uint64))


def sketch(h: np.ndarray) -> tuple[bytes, list[int]]:
    """Fingerprint and shard keys of a set of shingles."""
    ones = np.zeros(BITS, np.int64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(h), CHUNK):
        part = h[start : start + CHUNK]
        for k, odd in enumerate(_ODD[BANDS * BAND_ROWS :]):
            ones[64 * k : 64 * (k + 1)] += bit_counts(_mixed(part, odd))
        np.minimum(least, [_mixed(part, odd).min() for odd in _ODD[: BANDS * BAND_ROWS]], out=least)
    keys = [xxhash.xxh64_intdigest(least[k * BAND_ROWS : (k + 1) * BAND_ROWS].tobytes(), k) for k in range(BANDS)]
    return np.packbits(ones * 2 > len(h)).tobytes(), keys


def _sketches(words: int):
    """Of rows (id, k, text): id, k, the set's digest, its size, its fingerprint and its shard keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                sets = [shingles(t.as_py(), words) for t in batch.column(2)]
                made = [sketch(h) for h in sets]
                node = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in sets], dtype=np.uint64).view(np.int64)
                keys = np.array([k for _, k in made], dtype=np.uint64).view(np.int64).reshape(-1, BANDS)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), pa.array(map(len, sets), pa.int32()), pa.array([c for c, _ in made], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))], names=["id", "k", "node", "size", "code", "keys"])

    return run


def _sets(words: int):
    """Of rows (node, size, code, text): node, size, code and its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingles(t.as_py(), words).view(np.int64) for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, pa.list_(pa.int64()))], names=["node", "size", "code", "items"])

    return run


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two ascending sets are at least so similar."""
    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return common >= similarity * (len(x) + len(y) - common)


def _link(codes: list[int], sizes: list[int], forest: Forest, similarity: float, items: list[np.ndarray] | None = None) -> set[int]:
    """Join in the forest what links: surely, or by comparison where the sets are given. Without them, the
    places with a pair that the forest leaves apart and that may yet link."""
    wide, sure = distance_at(similarity, REACH), distance_at(similarity, -SURE)
    small = distance_at(similarity, SMALL_REACH)
    tree, open_ = BKTree(), []
    # The larger sets first: whichever set of a pair is small, the later one is.
    order = sorted(range(len(codes)), key=lambda i: -sizes[i])
    for i in order:
        code, size = codes[i], sizes[i]
        for j in map(order.__getitem__, tree.near(code, wide if size >= SMALL else small)):
            low, high = sorted((size, sizes[j]))
            if low < similarity * high or forest.root(i) == forest.root(j):
                continue
            if low >= SMALL and (codes[j] ^ code).bit_count() <= sure:
                forest.join(j, i)
            elif items is None:
                open_.append((i, j))
            elif similar(items[i], items[j], similarity):
                forest.join(j, i)
        tree.add(code)
    return {x for pair in open_ if forest.root(pair[0]) != forest.root(pair[1]) for x in pair}


#: Rows of both searches: a link (a, b), or with a shard and blocks, a node a of family b whose pairs are open.
_FOUND = "a long, b long, shard long, i long, j long"


def _shards(similarity: float, exact: bool):
    """Links, and if not exact open nodes, of rows (shard, i, j, node, size, code and, if exact, family, items)
    sorted by shard and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, out = None, [], []

        def finish() -> None:
            if len(held) > 1:
                nodes, sizes, codes, families, items = zip(*held, strict=True)
                forest, first = Forest(len(nodes)), {}
                for i, family in enumerate(families if exact else ()):
                    forest.join(first.setdefault(family, i), i)
                still = _link(codes, sizes, forest, similarity, items if exact else None)
                groups: dict[int, list[int]] = {}
                for i, node in enumerate(nodes):
                    groups.setdefault(forest.root(i), []).append(node)
                for g in map(sorted, groups.values()):
                    out.extend((g[(j - 1) // FANOUT], g[j], None, None, None) for j in range(1, len(g)))
                out.extend((nodes[i], nodes[forest.root(i)], *shard) for i in sorted(still))
            held.clear()

        def pack() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in range(5)], names=["a", "b", "shard", "i", "j"])
            out.clear()
            return made

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:6]]
            extra = zip(batch.column(6).to_pylist(), batch.column(7), strict=True) if exact else ((None, None) for _ in range(batch.num_rows))
            for s, i, j, node, size, code, (family, items) in zip(*columns, extra, strict=True):
                if (s, i, j) != shard:
                    finish()
                    shard = s, i, j
                    if len(out) > 50_000:
                        yield pack()
                held.append((node, size, int.from_bytes(code, "big"), family, items.values.to_numpy().view(np.uint64).copy() if exact else None))
        finish()
        yield pack()

    return run


def _digest(name: str):
    return F.col(name).cast("string").cast("binary")


def _links(docs: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """Edges (a, b) that connect all nodes whose sets are similar; docs: (k, text), nodes: one row per set."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = nodes.select(F.explode("keys").alias("shard"), "node", "size", "code")
    live = materialize(keys.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("items")).filter("n > 1"), "live")
    # Most shards have one node: those stay where they are.
    several = HitFilter(live.select(_digest("shard").alias("digest")), live.count())
    keys = several.mark(keys.withColumn("digest", _digest("shard")), "hit").filter("hit").drop("digest", "hit")
    met = lookup(keys, live.select("shard", "n", "items"), "shard", "n", BANDS * nodes.count())
    # A large shard is dealt as pairs of blocks (i, j); a node of block i goes to all pairs that have i.
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("items") / BLOCK_ITEMS))
    met = met.withColumn("at", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = met.select("shard", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "node", "size", "code")
    place = ("shard", "i", "j")
    found = materialize(map_arrow(dealt.repartition(parts, *place).sortWithinPartitions(*place, "node"), _shards(similarity, False), _FOUND), "found")
    release(live)
    still = found.filter("shard IS NOT NULL").select(*place, F.col("a").alias("node"), F.col("b").alias("family"))
    asked = materialize(still.select("node").distinct().join(nodes.select("node", "size", "code", F.col("best.k").alias("k")), "node"), "asked")
    held = HitFilter(asked.select(_digest("k").alias("digest")), asked.count())
    texts = held.mark(docs.withColumn("digest", _digest("k")), "hit").filter("hit").join(asked, "k").dropDuplicates(["node"])
    sets = materialize(map_arrow(texts.select("node", "size", "code", "text"), _sets(words), "node long, size int, code binary, items array<long>"), "sets")
    again = still.join(sets, "node").select(*place, "node", "size", "code", "family", "items")
    compared = map_arrow(again.repartition(parts, *place).sortWithinPartitions(*place, "node"), _shards(similarity, True), _FOUND)
    return found.filter("shard IS NULL").unionByName(compared).select("a", "b")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, all columns, less every near copy but the one of its group with the smallest id."""
    key = F.xxhash64(col(id_col), F.coalesce(col(text_col), F.lit("")))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = materialize(map_arrow(docs.select(col(id_col).alias("id"), key.alias("k"), col(text_col).alias("text")), _sketches(words), f"id {kind}, k long, node long, size int, code binary, keys array<long>"), "sketches")
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("k").alias("k"))
    nodes = materialize(rows.groupBy("node").agg(F.min(order).alias("best"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("code").alias("code"), F.first("keys").alias("keys")), "nodes")
    roots = components(_links(docs.select(key.alias("k"), col(text_col).alias("text")), nodes, words, similarity))
    # Nodes that meet others, or hold several rows: the best of their component by node, then the rows that go.
    placed = nodes.select("node", "best", "n").join(roots, "node", "left").filter("root IS NOT NULL OR n > 1").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "placed")
    least = placed.groupBy("root").agg(F.min("best").getField("k").alias("stays"), F.count("*").alias("members"))
    best = materialize(lookup(placed, least, "root", "members", placed.count()).select("node", "n", "stays"), "best")
    met = materialize(lookup(rows.select("node", "k"), best, "node", "n", rows.count()).select("k", (F.col("k") != F.col("stays")).alias("goes")).distinct(), "met")
    drop = met.filter("goes").select("k")
    held = HitFilter(met.select(_digest("k").alias("digest")), met.count())
    marked = held.mark(docs.select(F.struct("*").alias("rec"), key.alias("k")).withColumn("digest", _digest("k")), "hit")
    once = marked.filter(~F.col("hit")).select("rec.*")
    rest = marked.filter("hit").join(drop, "k", "left_anti").dropDuplicates(["k"]).select("rec.*")
    return once.unionByName(rest)
