"""Exact deduplication by a log-structured merge index of text digests (DataFrame functions only).

Memtable: what one task reads. It flushes, without a shuffle, to a run: a Parquet file sorted by
digest, whose min/max statistics and Parquet Bloom filters let point look-ups skip it. Compaction
merges runs into one sorted index with one entry per digest; of the identifiers under a digest it
keeps the smallest in survivor order (`keep="largest"` reverses that order). A bitmap filter of
bounded size over the digests seen more than once finds the hits in the texts; hits are verified
byte by byte: grouped by digest and whole text, copies collapsing within each task first. If any
digest covers different texts, its rows are regrouped by their whole text instead.

Defined results: null text counts as empty; rows that share id and text are separate rows of which
one is kept; a null id sorts below every other in survivor order, so such a row stays only if its
group has no other; of rows that share id and text `drop_copies` keeps the one whose columns have the smallest
hash; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER, UPPER, col, lookup, materialize, release

#: Bits of the largest hit filter (8 MB as bitmaps); beyond it more rows pass, never fewer.
MAX_FILTER_BITS = 1 << 26
#: Bits in one bitmap of Spark's bitmap functions; a fixed value.
BITMAP_BITS = 32768


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class DigestIndex:
    """Runs of (digest, best, n) in the shared folder: flushed, merged when `fanout` of a level pile up."""

    def __init__(self, keep: str = "largest", fanout: int = 8):
        if keep not in ("largest", "smallest"):
            raise ValueError(f"keep must be largest or smallest, not {keep!r}")
        self.keep, self.fanout, self.levels = keep, fanout, []

    def ident(self, id_: Column, row: Column) -> Column:
        """The survivor order: the greatest of these is kept (nulls sort lowest in a struct)."""
        return F.struct(id_.alias("id"), row.alias("row")) if self.keep == "largest" else F.struct((~F.isnull(id_)).alias("known"), id_.alias("id"), row.alias("row"))

    def merge(self, run: DataFrame) -> DataFrame:
        best = F.max("best") if self.keep == "largest" else F.min(F.struct((~F.col("best.known")).alias("a"), F.col("best.id").alias("b"), F.col("best.row").alias("c"), F.col("best").alias("best"))).getField("best")
        return run.groupBy("digest").agg(best.alias("best"), F.sum("n").alias("n"))

    def _write(self, run: DataFrame, tag: str) -> DataFrame:
        return materialize(run.sortWithinPartitions("digest"), tag, **{"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.max.bytes": str(1 << 20)})

    def flush(self, batch: DataFrame) -> DataFrame:
        """Write a batch (digest, id, row and more) as one sorted run per task; returns the run."""
        run = self._write(batch.withColumns({"best": self.ident(F.col("id"), F.col("row")), "n": F.lit(1).cast("long")}), "run")
        self.add(run.select("digest", "best", "n"), 0)
        return run

    def add(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self.add(self._write(self.merge(_union(runs)), "level"), level + 1)

    def compact(self) -> DataFrame:
        """Merge everything into one sorted run: an entry per digest."""
        run = self._write(self.merge(_union([r for level in self.levels for r in level])), "index")
        self.levels = [[], [run]]
        return run


def _union(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


class HitFilter:
    """One hash, one bit: tells which digests may be in a set. Its bitmaps are broadcast; their
    size is bounded by MAX_FILTER_BITS, whatever the number of digests."""

    def __init__(self, digests: DataFrame, n: int):
        self.bits = BITMAP_BITS
        while self.bits < MAX_FILTER_BITS and self.bits < 16 * n:
            self.bits *= 2
        at = self._at(F.col("digest"))
        self.bitmaps = digests.select(at.alias("at")).groupBy((F.col("at").bitwiseAND(F.lit(self.bits // BITMAP_BITS - 1))).alias("slot")).agg(F.bitmap_construct_agg(F.shiftrightunsigned("at", 11).bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("bitmap"))

    @staticmethod
    def _at(digest: Column) -> Column:
        return F.xxhash64(digest).bitwiseAND(F.lit((1 << 62) - 1))

    def mark(self, rows: DataFrame, name: str) -> DataFrame:
        """Add a boolean column: false where row's `digest` is certainly not in the set."""
        at = self._at(F.col("digest"))
        bit = F.shiftrightunsigned(at, 11).bitwiseAND(F.lit(BITMAP_BITS - 1)).cast("int")
        rows = rows.withColumns({"slot": at.bitwiseAND(F.lit(self.bits // BITMAP_BITS - 1)), "bit": bit})
        byte = F.conv(F.hex(F.substring("bitmap", F.shiftright("bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.expr("shiftright(byte, bit % 8)").bitwiseAND(F.lit(1)) == 1, F.lit(False))
        return rows.join(F.broadcast(self.bitmaps), "slot", "left").withColumn("byte", byte).withColumn(name, hit).drop("slot", "bit", "bitmap", "byte")


class _State:
    """The index over a table, its log of rows, the filter of hits and the digests with several texts."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, keep: str, digest: Callable[[Column], Column]):
        self.lsm = DigestIndex(keep)
        norm = fold_ascii(col(text_col))
        texts = docs.select(col(id_col).alias("id"), norm.alias("norm"))
        batch = texts.select("id", F.monotonically_increasing_id().alias("row"), digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("sha"))
        self.log = self.lsm.flush(batch)
        self.index = self.lsm.compact()
        self.total = self.log.count()
        hits = self.index.filter("n > 1").select("digest")
        self.filter = HitFilter(hits, hits.count())
        seen = self.filter.mark(texts.withColumn("digest", digest(F.col("norm"))), "hit").filter("hit")
        self.collided = materialize(seen.groupBy("digest", "norm").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest"), "collided")
        self.n_collided = self.collided.count()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256."""
    s = _State(docs, id_col, text_col, keep, digest)
    rows = s.log.select("id", "row", "digest", "sha")
    index = s.index
    if s.n_collided:
        # Rows of digests that cover several texts: the whole text is the key.
        norm = docs.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), fold_ascii(col(text_col)).alias("norm"))
        odd = materialize(norm.withColumn("digest", digest(F.col("norm"))).join(s.collided, "digest", "left_semi").select("id", "row", F.sha2("norm", 256).alias("sha"), F.encode("norm", "UTF-8").alias("digest")), "odd")
        exact = DigestIndex(keep)
        odd_index = exact.merge(odd.select("digest", exact.ident(F.col("id"), F.col("row")).alias("best"), F.lit(1).cast("long").alias("n")))
        rows = rows.join(s.collided, "digest", "left_anti").unionByName(odd)
        index = index.join(s.collided, "digest", "left_anti").unionByName(odd_index)
    out = lookup(rows, index, "digest", "n", s.total)
    return out.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of docs, all columns, less every copy but the one that stays.

    Texts that the hit filter rules out are passed on without a shuffle; only possible copies move.
    """
    s = _State(docs, id_col, text_col, keep, digest)
    if s.n_collided:
        key = lambda c: F.encode(c, "UTF-8")
        s = _State(docs, id_col, text_col, keep, key)
    else:
        key = digest
    rows = docs.select(F.struct("*").alias("rec"), col(id_col).alias("id"), key(fold_ascii(col(text_col))).alias("digest"))
    marked = s.filter.mark(rows, "hit")
    once = marked.filter(~F.col("hit")).select("rec.*")
    best = s.index.select("digest", F.col("best.id").alias("best_id"), "n")
    kept = lookup(marked.filter("hit").drop("hit"), best, "digest", "n", s.total).filter(F.col("id").eqNullSafe(F.col("best_id")))
    # Rows of one id and text: the one whose columns have the smallest hash.
    return once.unionByName(kept.groupBy("digest").agg(F.min_by("rec", F.xxhash64("rec")).alias("rec")).select("rec.*"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: every row of documents; of equal texts the row with the largest doc_id stays."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d"""
