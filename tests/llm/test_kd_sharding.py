"""K-d sharding: what every row says, equal bytes, and each split against a slow weighted median."""

import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from weirline.llm import kd_sharding as kd
from weirline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def check(rows, docs, shards, spare):
    """rows of the result, docs (doc_id, text): whole, gapless, nearly equal."""
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None for r in rows)
    slots, sizes = collections.defaultdict(list), [0] * shards
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes) - min(sizes) <= spare, sizes
    return sizes


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    largest = max(len((t or "").encode()) + 1 for _, t in docs)
    check(QUERIES["op13_kd_sharding"](spark, sf).collect(), docs, 16, 2 * largest)


def test_each_split_is_the_weighted_median_of_the_widest_dimension(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    points = kd._points(docs, "doc_id", "text", kd.DIMENSIONS)
    tree = kd.KdTree(points, 4, 16, None, tolerance=0.0)
    rows = points.collect()
    whole = [max(r[f"d{k}"] for r in rows) - min(r[f"d{k}"] for r in rows) for k in range(4)]
    held = {1: rows}
    assert len(tree.splits) == 15
    for n in tree.splits:
        mine = held[n.number]
        width = [(max(r[f"d{k}"] for r in mine) - min(r[f"d{k}"] for r in mine)) / whole[k] if whole[k] else 0.0 for k in range(4)]
        assert n.dim == width.index(max(width)) and n.size == sum(r.size for r in mine)
        keys = sorted(((r[f"d{n.dim}"], r.crc, r.row), r) for r in mine)
        # The prefix of rows whose bytes are nearest to half, the longer one of two that are equally near.
        total, best = 0, (n.size / 2, 0, 0)
        for i, (_, r) in enumerate(keys, 1):
            total += r.size
            best = min(best, (abs(total - n.size / 2), -total, i))
        assert {k for k, _ in keys if k <= n.cut} == {k for k, _ in keys[: best[2]]}
        held[2 * n.number], held[2 * n.number + 1] = [r for k, r in keys if k <= n.cut], [r for k, r in keys if k > n.cut]


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 16])
def test_a_hot_group_of_copies_is_split_and_others_stay_together(spark, shards):
    rows = [(k, "copy " * 20, "en", "hot", 100) for k in range(400)] + [(1000 + k, f"text {k // 2} " * 20, "de", f"s{k % 5}", k) for k in range(600)]
    out = kd.kd_shards(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=shards).collect()
    check(out, [r[:2] for r in rows], shards, 500)


def test_target_bytes_settle_the_number_of_shards(spark):
    rows = [(k, "x" * 99, "en", "a", 99) for k in range(100)]
    out = kd.kd_shards(spark.createDataFrame(rows, SCHEMA), target_bytes=1200).collect()
    sizes = check(out, [r[:2] for r in rows], 9, 200)
    assert len(sizes) == 9 and max(sizes) <= 1200


def test_rows_that_are_equal_in_all_are_split_by_place(spark):
    rows = [(7, "same", "en", "a", 4)] * 160
    sizes = check(kd.kd_shards(spark.createDataFrame(rows, SCHEMA), shards=16).collect(), [r[:2] for r in rows], 16, 5)
    assert sizes == [50] * 16


def test_nulls_long_texts_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (1, "é" * 50_000, "en", "a", None), (2, None, None, "ü", -5), (2, None, None, "ü", -5), (3, "b" * 90_000, "en", None, 2)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("node", "shard", "size", "row", "at", "d0", "crc", "part", "id")})
    check(kd.kd_shards(docs, shards=4).collect(), [r[:2] for r in rows], 4, 100_002)


def test_fewer_rows_than_shards_and_an_empty_table(spark):
    rows = [(1, "a", "en", "s", 1), (2, "b", "en", "s", 1)]
    out = kd.kd_shards(spark.createDataFrame(rows, SCHEMA), shards=16).collect()
    check(out, [r[:2] for r in rows], 16, 2)
    assert len({r.shard for r in out}) == 2
    assert kd.kd_shards(spark.createDataFrame([], SCHEMA), shards=16).collect() == []


def test_neither_number_nor_bytes(spark):
    with pytest.raises(ValueError, match="target_bytes"):
        kd.kd_shards(spark.createDataFrame([], SCHEMA))


def test_coordinates_keep_the_order_of_values(spark):
    frame = spark.createDataFrame([(math.nan, "b", True), (-1.5, "é", False), (3.0, "", None), (None, None, True)], "x double, s string, b boolean")
    got = [tuple(r) for r in frame.select(*(kd.coordinate(F.col(c), frame.schema[c].dataType) for c in "xsb")).collect()]
    assert got == [(None, float(int("620000000000", 16)), 1.0), (-1.5, float(int("c3a900000000", 16)), 0.0), (3.0, 0.0, None), (None, None, 1.0)]
