"""K-d tree sharding by bytes (DataFrame functions only).

The rows are points of their metadata. A node of the tree is split across its widest dimension, relative to the
table's own extent, at the weighted median: the place where half of the node's bytes (or the share of the
shards that go left) lie below. Splitting goes on until the leaves reach the target bytes, so shards hold rows that are
near in metadata, and nearly equal bytes (the law is `bytes`).

A median is found without sorting or collecting a node: the candidates' range is cut into BUCKETS equal parts, one aggregation sums
the bytes of each part for all nodes of a level, and the part across which the median falls becomes the next range,
until it holds no more than TOLERANCE of a shard, or one row. Where a value is so frequent that its rows straddle the
median, they are split by the text's CRC-32, so that equal texts stay together as long as they can, and where equal
texts straddle it, by the row's place. What reaches the driver, and is broadcast, is one row a node, so at most as many as
shards; the points are narrow and are never shuffled until they are numbered. That is done in the parts of the
input that they were read from, and the parts before add their counts.

Defined results: null text has no bytes, so its size is 1 and its CRC-32 that of nothing, 0; a null (or NaN) in a dimension
lies with the smallest value; numbers that a double can't tell apart, and texts with the same first six bytes,
tie; repeated rows are rows of their own; a null id is kept; of an empty table nothing is sharded; with fewer rows than
shards some shards are empty. Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import col, materialize, release

#: Parts that a median's range is cut into.
BUCKETS = 4096
#: The bytes that may lie on the wrong side of a median, as a share of a shard.
TOLERANCE = 1 / 1024
#: Coordinates lie between this and its negative, so that extents are finite; infinite values lie there.
FAR = 1e300
#: Metadata of documents, the first of equally wide dimensions first.
DIMENSIONS = ["source", "lang", "n_chars", "doc_id"]
#: What splits rows of one value: the text's CRC-32, then the row.
TIES = ["crc", "row"]


def coordinate(c: Column, kind: T.DataType) -> Column:
    """A number in the order of the values: numbers and times as doubles, texts by their first six bytes."""
    if isinstance(kind, T.NumericType):
        value = c.cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(c.cast("timestamp")).cast("double")
    elif isinstance(kind, T.BooleanType):
        value = c.cast("int").cast("double")
    else:
        text = F.rpad(F.hex(F.substring(F.encode(c.cast("string"), "UTF-8"), 1, 6)), 12, "0")
        value = F.conv(text, 16, 10).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), F.least(F.greatest(value, F.lit(-FAR)), F.lit(FAR)))


@dataclass
class Node:
    """A part of the tree: its shards and bytes, and where it is split. number: 1 for the root, 2n and 2n + 1 below n."""

    number: int
    first: int
    shards: int
    size: int
    #: The dimension it is split across; none (-1) where all its rows are at one point.
    dim: int = -1
    #: The values of the first keys (the dimension, then the ties) that are settled; the range of the next; the bytes below it.
    fixed: list[float] = field(default_factory=list)
    low: float = 0.0
    high: float = 0.0
    below: int = 0
    #: Rows whose keys are at most this go left.
    cut: tuple[float, ...] = ()
    left_size: int = 0

    @property
    def left(self) -> int:
        return self.shards // 2

    @property
    def wanted(self) -> float:
        """The bytes that should go left."""
        return self.size * self.left / self.shards

    def settle(self, value: float, before: bool, left_size: int) -> None:
        """Cut before or after this value of the key in question."""
        head = [*self.fixed, math.nextafter(value, -math.inf) if before else value]
        self.cut, self.left_size = (*head, *[math.inf] * (KEYS - len(head))), left_size


#: A row's keys in its node: the dimension's coordinate, the CRC-32, the row.
KEYS = 1 + len(TIES)


def _keys(dims: list[str]) -> Column:
    coord = F.element_at(F.array(*map(F.col, dims)), F.greatest("dim", F.lit(0)) + 1) if dims else F.lit(0.0)
    return F.array(F.when(F.col("dim") >= 0, coord).otherwise(F.lit(0.0)), *map(F.col, TIES))


class KdTree:
    """The tree over written points: size, crc, row, the dimensions d0, d1, ... (doubles, no nulls) and whatever else.

    A level's nodes are a table of at most as many rows as there are shards, which is broadcast to the points.
    """

    def __init__(self, points: DataFrame, dims: int, shards: int | None, target: int | None, tolerance: float = TOLERANCE):
        self.spark, self.dims = points.sparkSession, [f"d{k}" for k in range(dims)]
        self.points = points.withColumn("node", F.lit(1).cast("long"))
        whole = points.agg(F.sum("size").alias("size"), *self._extent()).first()
        self.widths = {d: (whole[f"max_{d}"] or 0.0) - (whole[f"min_{d}"] or 0.0) for d in self.dims}
        size = whole["size"] or 0
        self.shards = shards or max(1, -(-size // target))
        self.slack = tolerance * size / self.shards
        self.splits: list[Node] = []
        self.leaves: list[Node] = []
        level, self.written = [Node(1, 0, self.shards, size)], None
        while level:
            self.leaves += [n for n in level if n.shards == 1]
            level = [n for n in level if n.shards > 1]
            if level:
                self._split([n for n in level if n.size])
                lower = materialize(self._down(level), "level")
                self.release()
                self.points = self.written = lower
                self.splits += level
                level = [c for n in level for c in (Node(2 * n.number, n.first, n.left, n.left_size), Node(2 * n.number + 1, n.first + n.left, n.shards - n.left, n.size - n.left_size))]

    def release(self) -> None:
        """Delete the points that the tree wrote."""
        if self.written is not None:
            release(self.written)

    def _extent(self) -> list[Column]:
        return [f(d).alias(f"{n}_{d}") for d in [*self.dims, *TIES] for n, f in (("min", F.min), ("max", F.max))]

    def _with(self, rows: list[tuple], schema: str) -> DataFrame:
        """The points of the nodes that the rows are about, with their values."""
        return self.points.join(F.broadcast(self.spark.createDataFrame(rows, f"node long, dim int, {schema}")), "node")

    def _split(self, level: list[Node]) -> None:
        """Find each node's widest dimension and its median there."""
        seen = {r["node"]: r for r in self.points.groupBy("node").agg(*self._extent()).collect()}
        for n in level:
            r = seen[n.number]
            relative = [(r[f"max_{d}"] - r[f"min_{d}"]) / self.widths[d] if self.widths[d] else 0.0 for d in self.dims]
            if max(relative, default=0.0) > 0:
                n.dim = relative.index(max(relative))
                n.low, n.high = r[f"min_d{n.dim}"], r[f"max_d{n.dim}"]
            else:
                n.fixed, n.low, n.high = [0.0], r[f"min_{TIES[0]}"], r[f"max_{TIES[0]}"]
        while level:
            level = self._narrow(level, seen)

    def _narrow(self, open_: list[Node], seen: dict) -> list[Node]:
        """One aggregation for all open nodes: the part of the range that holds the median; the nodes still open."""
        rows = [(n.number, n.dim, len(n.fixed), [*n.fixed, *[0.0] * (KEYS - len(n.fixed))], n.low, n.high, n.wanted - n.below) for n in open_]
        points = self._with(rows, "settled int, fixed array<double>, low double, high double, wanted double").withColumn("keys", _keys(self.dims))
        key = F.element_at("keys", F.col("settled") + 1)
        same = F.slice("keys", F.lit(1), F.col("settled")) == F.slice("fixed", F.lit(1), F.col("settled"))
        inside = points.withColumn("key", key).filter(same & F.col("key").between(F.col("low"), F.col("high")))
        share = (F.col("key") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
        part = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1))
        parts = inside.groupBy("node", "wanted", part.alias("part")).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        # At most BUCKETS rows a node.
        running = parts.withColumn("total", F.sum("size").over(W.partitionBy("node").orderBy("part")))
        crossing = running.filter(F.col("total") >= F.col("wanted")).groupBy("node").agg(F.min(F.struct("part", "total", "size", "n", "low", "high")).alias("b"))
        still = []
        found = {r["node"]: r["b"] for r in crossing.collect()}
        for n in open_:
            b = found[n.number]
            before, after = n.below + b["total"] - b["size"], n.below + b["total"]
            last = b["low"] == b["high"] and len(n.fixed) + 1 == KEYS
            if b["n"] == 1 or b["size"] <= self.slack or last:
                # On the side of this part that is nearer to what is wanted.
                short = n.wanted - before < after - n.wanted
                n.settle(b["low"] if short else b["high"], short, before if short else after)
                continue
            n.below = before
            if b["low"] < b["high"]:
                n.low, n.high = b["low"], b["high"]
            else:
                # One value, too frequent: its rows are told apart by the next key.
                n.fixed.append(b["low"])
                tie = TIES[len(n.fixed) - 1]
                n.low, n.high = seen[n.number][f"min_{tie}"], seen[n.number][f"max_{tie}"]
            still.append(n)
        return still

    def _down(self, level: list[Node]) -> DataFrame:
        """All points, those of the split nodes one level lower."""
        rows = [(n.number, n.dim, list(n.cut)) for n in level if n.cut]
        cuts = F.broadcast(self.spark.createDataFrame(rows, "node long, dim int, cut array<double>"))
        joined = self.points.join(cuts, "node", "left")
        # Arrays compare element by element.
        lower = F.when(F.coalesce(_keys(self.dims) <= F.col("cut"), F.lit(False)), 2 * F.col("node")).otherwise(2 * F.col("node") + 1)
        return joined.withColumn("node", F.when(F.col("cut").isNull(), F.col("node")).otherwise(lower)).drop("dim", "cut")

    def placed(self) -> DataFrame:
        """The points with their shard."""
        leaves = self.spark.createDataFrame([(n.number, n.first) for n in self.leaves], "node long, shard int")
        return self.points.join(F.broadcast(leaves), "node").drop("node")


def _points(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    coords = [coordinate(col(d), docs.schema[d].dataType).alias(f"d{k}") for k, d in enumerate(dims)]
    row = F.monotonically_increasing_id()
    picked = docs.select(col(id_col).alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), row.alias("at"), *coords)
    return materialize(picked.withColumns({"crc": F.col("text_crc32").cast("double"), "row": F.col("at").cast("double")}), "points")


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", dims: list[str] | None = None) -> DataFrame:
    """Every row of docs: id_col, size, text_crc32, law, shard, slot, grown_shard.

    shards, or target_bytes, from which their number follows; dims: the metadata columns that span the space.
    """
    if not (shards or target_bytes):
        raise ValueError("either shards or target_bytes must be given")
    dims = dims or [d for d in DIMENSIONS if d in docs.columns]
    points = _points(docs, id_col, text_col, dims)
    # Nulls lie with the smallest value.
    least = points.agg(F.count("*"), *(F.min(f"d{k}").alias(f"d{k}") for k in range(len(dims)))).first()
    filled = points.withColumns({f"d{k}": F.coalesce(f"d{k}", F.lit(least[f"d{k}"] or 0.0)) for k in range(len(dims))}) if dims else points
    tree = KdTree(filled, len(dims), shards, target_bytes)
    placed = materialize(tree.placed().select("id", "size", "text_crc32", "at", "shard"), "shards")
    tree.release()
    release(points)
    # The part of the input that a row was read from, at most as large as a task's share of it.
    part = F.shiftrightunsigned("at", 33).alias("part")
    counts = placed.groupBy("shard", part).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("shard", "part", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("shard", "part").orderBy("at")) - 1
    out = placed.withColumn("part", part).join(offsets, ["shard", "part"]).withColumn("slot", (F.col("before") + inside).cast("long"))
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_kd_sharding(spark, sf_dir: str) -> DataFrame:
    """Query: all documents in sixteen shards of nearly equal bytes."""
    return kd_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=16)
