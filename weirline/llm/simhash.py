"""SimHash near-duplicates by BK-trees over shards of the fingerprints.

Two fingerprints within three bits agree on at least one of four 16-bit blocks and, of the other 48
bits, on at least one of four 12-bit blocks. So each distinct fingerprint is dealt to 16 shards
(block, sub-block, their values), and every link lies inside some shard: nothing is lost. The task
that holds a shard builds its BK-tree (children keyed by integer Hamming distance to the parent) and
queries it with each of the shard's fingerprints, following only edges within the radius. Shards of
more than LEAF fingerprints are split again, by the same argument, on the bits left free. Trees are
shipped with their shard through the shuffle rather than by a broadcast from the driver, which would
have to collect the fingerprints of all documents. A shard gives back a spanning forest of its
links, of bounded degree, never all pairs; components are found by contraction.

Defined results: null text counts as empty; no words: fingerprint zero, linked like any other; fewer words than a shingle: the
whole sequence is one shingle; repeated rows give repeated result rows; a null id gets its component,
whose id is the smallest non-null id reachable, or null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, lookup, map_arrow, materialize
from ._components import components

SEED, RADIUS, WORDS = 42, 3, 3
#: Largest BK-tree; larger shards are split on their free bits.
LEAF = 2048
#: Edges of a forest node to its children: bounds the degree of hubs.
FANOUT = 32
#: Shingles hashed at a time; bounds the memory of a long text.
CHUNK = 1 << 15


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, highest bit first.

    Bits are bytes here, eight to a machine word, and 255 of those are added before a byte can overflow.
    """
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the word shingles of a text, as an unsigned integer."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, CHUNK):
        part = [digest(b" ".join(tokens[i : i + words]), SEED) for i in range(start, min(n, start + CHUNK))]
        ones += bit_counts(np.array(part, dtype=np.uint64))
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


class BKTree:
    """Nodes in insertion order; kids[i] maps a distance to the child at that distance."""

    def __init__(self):
        self.codes: list[int] = []
        self.kids: list[dict[int, int]] = []

    def near(self, code: int, radius: int) -> Iterator[int]:
        """Indexes of the nodes within radius."""
        codes, kids = self.codes, self.kids
        stack = [0] if codes else []
        while stack:
            i = stack.pop()
            d = (codes[i] ^ code).bit_count()
            if d <= radius:
                yield i
            for edge, child in kids[i].items():
                if -radius <= edge - d <= radius:
                    stack.append(child)

    def add(self, code: int) -> None:
        self.codes.append(code)
        self.kids.append({})
        if len(self.codes) == 1:
            return
        i, new = 0, len(self.codes) - 1
        while True:
            d = (self.codes[i] ^ code).bit_count()
            child = self.kids[i].get(d)
            if child is None:
                self.kids[i][d] = new
                return
            i = child


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def link_shard(codes: np.ndarray, free: list[int], forest: Forest, at: np.ndarray, radius: int, leaf: int = LEAF) -> None:
    """Join in the forest all codes within radius; at: their positions; free: bits on which they can differ."""
    if len(codes) <= max(leaf, 1 << radius):
        tree = BKTree()
        for i, code in enumerate(codes.tolist()):
            for j in tree.near(code, radius):
                forest.join(int(at[i]), int(at[j]))
            tree.add(code)
        return
    for part in np.array_split(np.array(free), radius + 1):
        if not len(part):
            raise ValueError("more distinct codes than their free bits allow")
        mask = np.uint64(sum(1 << int(b) for b in part))
        key = codes & mask
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        rest = [b for b in free if not int(mask) >> b & 1]
        for group in np.split(order, cuts):
            if len(group) > 1:
                link_shard(codes[group], rest, forest, at[group], radius, leaf)


def shard_edges(codes: np.ndarray, free: list[int], radius: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """A spanning forest of a shard's links, as pairs of codes: each component's codes in order, as a
    tree of FANOUT children a node."""
    if len(codes) == 2:
        x, y = codes.tolist()
        return [(x, y)] if (x ^ y).bit_count() <= radius else []
    forest = Forest(len(codes))
    link_shard(codes, free, forest, np.arange(len(codes)), radius, leaf)
    groups: dict[int, list[int]] = {}
    for i, code in enumerate(codes.tolist()):
        groups.setdefault(forest.root(i), []).append(code)
    return [(g[(k - 1) // FANOUT], g[k]) for g in groups.values() if len(g) > 1 for k in range(1, len(g))]


def _free_bits(shard: int) -> list[int]:
    """Bits that a shard leaves free: block b fixes its 16 bits, sub-block j 12 of the other 48."""
    block, sub = shard >> 30 & 3, shard >> 28 & 3
    rest = [b for b in range(64) if b // 16 != block]
    return rest[: 12 * sub] + rest[12 * (sub + 1) :]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _edges_of_sorted(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        out: list[tuple[int, int]] = []

        def flush() -> None:
            if shard is not None:
                codes = np.unique(np.concatenate(held))
                if len(codes) > 1:
                    out.extend(shard_edges(codes, _free_bits(shard), radius))

        def pack() -> pa.RecordBatch:
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays([pa.array(_signed([r[k] for r in rows])) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            keys = batch.column(0).to_numpy()
            codes = batch.column(1).to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            sizes = np.diff(cuts)
            for k in range(len(sizes)):
                start, end = cuts[k], cuts[k + 1]
                if start == end:
                    continue
                if keys[start] != shard:
                    flush()
                    shard, held = int(keys[start]), []
                    # A shard of one code inside this batch has no link.
                    if sizes[k] == 1 and k < len(sizes) - 1:
                        shard = None
                        continue
                held.append(codes[start:end])
            if len(out) > 50_000:
                yield pack()
        flush()
        yield pack()

    return run


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _signed([fingerprint(t.as_py(), words) for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes)], names=["id", "code"])

    return run


def links(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect exactly what links within radius do; codes: distinct longs in `code`."""
    if radius > 3:
        raise ValueError("four blocks and four sub-blocks cover a radius of 3 at most")
    keys = []
    for block in range(4):
        value = F.shiftrightunsigned("code", 16 * block).bitwiseAND(F.lit(0xFFFF))
        low = F.lit(0).cast("long") if block == 0 else F.col("code").bitwiseAND(F.lit((1 << 16 * block) - 1))
        high = F.lit(0).cast("long") if block == 3 else F.shiftrightunsigned("code", 16 * (block + 1))
        rest = low.bitwiseOR(F.shiftleft(high, 16 * block))
        for sub in range(4):
            piece = F.shiftrightunsigned(rest, 12 * sub).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((block << 30) + (sub << 28)).cast("long") + value * F.lit(1 << 32) + F.shiftleft(piece, 16))
    dealt = codes.select(F.explode(F.array(*keys)).alias("shard"), "code")
    n = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(dealt.repartition(n, "shard").sortWithinPartitions("shard", "code"), _edges_of_sorted(radius), "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id."""
    total, rows, groups = _grouped(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), words, radius)
    out = lookup(rows, groups, "code", "n", total)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def _grouped(docs: DataFrame, words: int, radius: int) -> tuple[int, DataFrame, DataFrame]:
    """Of (id, text): the number of rows; (id, code) by row; (code, n, component) by fingerprint."""
    kind = docs.schema["id"].dataType.simpleString()
    rows = materialize(map_arrow(docs, _fingerprints(words), f"id {kind}, code long"), "codes")
    codes = materialize(rows.groupBy("code").agg(F.min("id").alias("first"), F.count("*").alias("n")), "distinct")
    roots = components(links(codes.select("code"), radius))
    placed = codes.join(roots.select(F.col("node").alias("code"), "root"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    placed = materialize(placed, "placed")
    # Components are many and small, or few codes: their rows are reduced before they meet.
    least = placed.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("size"))
    groups = materialize(lookup(placed, least, "root", "size", codes.count()).select("code", "n", "component"), "groups")
    return rows.count(), rows, groups


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Query: fingerprints of 3-word shingles of all documents, linked at 3 or fewer differing bits."""
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
