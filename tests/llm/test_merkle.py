"""The Merkle manifest against a slow tree, also where every stage above the blocks is distributed."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from weirline.llm import merkle
from weirline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)}) if text is not None else None


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def runs_up(nodes):
    """Levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def slow(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, text, lang, source, n_chars), sorted."""
    groups = {}
    for r in rows:
        d, text, lang, source, n = r
        tampered = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        groups.setdefault(source, []).append((d is not None, d or 0, leaf_of(d, source, lang, n, text), leaf_of(d, source, lang, n, lower(text) if tampered else text), d))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s], key=lambda x: x[:3])) for s in order}
    levels = {s: runs_up([x[2] for x in trees[s]]) for s in order}
    top = runs_up([levels[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (_, _, leaf, seen, d) in enumerate(trees[s]):
            node, siblings = seen, ""
            for chain, place in ((levels[s], i), (top, at)):
                for level in chain[:-1]:
                    start = place // 16 * 16
                    left, right = level[start:place], level[place + 1 : start + 16]
                    siblings += "".join(left + right)
                    node = sha("".join([*left, node, *right]))
                    place //= 16
            out.append((d, leaf, levels[s][-1][0], top[-1][0], sha(siblings), node, node == top[-1][0]))
    return sorted(out, key=repr)


def digests(spark, rows, top=merkle.TOP, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = merkle.manifest(docs, claims={"text": F.when(F.col("text").isNotNull(), merkle.fold_ascii(F.col("text")))}, claimed=tampered, output="digests", top=top)
    return sorted(map(tuple, out.collect()), key=repr)


def table(sizes, text="Some Text {}"):
    """Rows of each source, in an order unlike the tree's."""
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((k * 7919 % 100_003, text.format(k), "en", source, k))
            k += 1
    return rows


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, sf).collect()), key=repr)
    assert got == slow(rows) and {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 17}, {"a": 1, "b": 2, "c": 15, "d": 16, "e": 17, None: 3, "f": 255, "g": 256, "h": 257, "i": 272, "j": 4097} | {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_shapes(spark, sizes):
    rows = table(sizes)
    assert digests(spark, rows) == slow(rows)


@pytest.mark.parametrize(("sizes", "top"), [({"a": 600, "b": 300, None: 1}, 4), ({f"s{k}": 1 + k % 3 for k in range(300)}, 4), ({f"s{k}": 1 for k in range(20)} | {"big": 5000}, 4)])
def test_stages_above_the_blocks_are_distributed(spark, sizes, top):
    rows = table(sizes)
    assert digests(spark, rows, top) == slow(rows)


def test_a_hot_source_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        rows = table({"a": 3, "hot": 1500, "z": 5})
        assert digests(spark, rows, parts=7) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nulls_empty_texts_repeats_and_ties(spark):
    rows = [(None, None, None, None, None), (None, "x", None, "a", 1), (None, "", "en", "a", None), (5, "Ab", "en", "", 2), (5, "Ab", "en", "", 2), (5, "aB", "en", "", 2), (10, "é" * 50_000 + "Z", "de", "ü", 1), (12, None, "en", "a", 3)]
    assert digests(spark, rows) == slow(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).collect() == [] and merkle.manifest(empty, output="digests").collect() == []


def test_paths_lead_from_each_leaf_to_the_root_and_to_no_other(spark):
    rows = table({"a": 40, "b": 300})
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("tree", "idx", "digest", "members", "path", "leaf")})
    got = merkle.manifest(docs).collect()
    assert len(got) == 340 and len({r.root for r in got}) == 1
    for r in got:
        steps = [(s["left"], s["right"]) for s in r.path]
        assert merkle.fold(r.leaf, steps) == r.root
        assert merkle.fold(sha("other"), steps) != r.root


def test_every_changed_row_is_found_whatever_its_field(spark):
    docs = spark.createDataFrame(table({"a": 60, "b": 3}), SCHEMA)
    out = merkle.manifest(docs, claims={"n_chars": F.col("n_chars") + 1}, claimed=F.col("n_chars") % 7 == 0, output="digests").join(docs.select("doc_id", "n_chars"), "doc_id")
    assert {(r.n_chars, r.verified) for r in out.collect()} == {(k, k % 7 != 0) for k in range(63)}
