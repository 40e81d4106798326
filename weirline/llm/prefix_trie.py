"""Conversation prefix trie: the prefixes that conversations share, and the tokens that sharing them saves.

A node is a distinct sequence of first turns. It is owned by its smallest member, the conversation of the smallest id
that starts with it; whoever owns a node owns the rest of its own path as well, so a conversation owns a suffix of its
path. From that follows one group-by over prefixes: what a node's subtree saves is the sum, over its members,
of the tokens of their turns from there on that they do not own; its leaves are the members that own
a childless end; its children are the members that own the next node of their path.

A prefix is known by its depth and four running sums, modulo 2**61, of words of SHA-256 over (depth, role, text): two
different prefixes of random texts share all four with a chance of 2**-244. Sums, unlike a chain of digests, can be
carried from one partition to the next, so a conversation of any length is spread over tasks (`_ranks.scan`), and so
is a node of any number of members: nodes are grouped with partial aggregation and rows find their node's
owner by a look-up that broadcasts the few hot nodes. The windows of the method are taken as these scans and minima,
for the root's own window would be all conversations in one task. The ids that end in a node are joined in
chunks of CHUNK, so a task that digests the ids of a hot node reads one row for each chunk, and holds one chunk.

Defined results: rows follow by turn (null first), then role, then the text's digest; a null role or text is
empty; repeated rows are separate turns; rows without a conversation id belong to none and are left out; other columns
are not read; a text of any length is read whole; an empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col, lookup, map_arrow, materialize, release
from ._ranks import scan

#: The words of a text (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: Identifiers of one end that are joined into one row.
CHUNK = 4096
LANES = ["s0", "s1", "s2", "s3"]
NODE = ["depth", *LANES]


def turn_digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def _lanes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, length, tokens, depth, digest) with a digest of depth and turn in four words of 61 bits; zeros at the root."""
    for batch in batches:
        depth, digest = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        raw = b"".join(hashlib.sha256(d.to_bytes(8, "little") + t).digest() if d else bytes(32) for d, t in zip(depth, digest, strict=True))
        words = np.frombuffer(raw, "<u8").reshape(-1, 4) >> np.uint64(3)
        lanes = [pa.array(words[:, k].astype(np.int64)) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(2), batch.column(3), *lanes], names=["conv_id", "length", "tokens", "path_tokens", *NODE])


def occurrences(paths: DataFrame) -> DataFrame:
    """Every place of every path: conv_id, length, the node's depth and sums, tokens and path_tokens (those of the path so far).

    paths: conv_id, length (turns of the path), depth (0 for the root, then without gaps), digest (of the turn; any at
    the root), tokens. Written.
    """
    schema = "conv_id long, length long, tokens long, path_tokens long, depth long, s0 long, s1 long, s2 long, s3 long"
    rows = map_arrow(paths.select("conv_id", "length", "tokens", "depth", "digest"), _lanes, schema)
    summed = scan(rows, ["conv_id"], ["depth"], [*LANES, "path_tokens"], tag="prefixes")
    out = materialize(summed.select("conv_id", "length", *NODE, "tokens", "path_tokens"), "occurrences")
    release(summed)
    return out


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node columns, chunk, ids), sorted: the digest of each node's ids, joined by commas, a chunk at a time."""
    node, state, done = None, None, []

    def flush(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([r[0][k] for r in rows], pa.int64()) for k in range(5)), pa.array([r[1] for r in rows], pa.string())], names=[*NODE, "ends_sha256"])

    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True))
        for key, ids in zip(keys, batch.column(6), strict=True):
            if key != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
        yield flush(done)
        done = []
    if node is not None:
        yield flush([(node, state.hexdigest())])


def ends(occ: DataFrame) -> DataFrame:
    """NODE and ends_sha256 of the nodes where conversations end; occ: NODE, conv_id of the ends."""
    placed = scan(occ, NODE, ["conv_id"], tag="ends")
    chunks = placed.groupBy(*NODE, F.expr(f"idx div {CHUNK}").alias("chunk")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "chunk", "ids")
    out = materialize(map_arrow(dealt, _hash_chunks, "depth long, s0 long, s1 long, s2 long, s3 long, ends_sha256 string"), "ends")
    release(placed)
    return out


def _find(rows: DataFrame, index: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    return lookup(rows, index, key, weight, total).drop(weight)


def trie(paths: DataFrame) -> DataFrame:
    """A row a node: conv_id (its owner), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    paths: see `occurrences`; every conversation has its root's row.
    """
    occ = occurrences(paths)
    total = occ.count()
    key = F.struct(*NODE).alias("node")
    # The node's smallest member owns it; a node that no member passes is childless.
    nodes = occ.groupBy(key).agg(F.min("conv_id").alias("owner"), (F.max("length") == F.max("depth")).alias("childless"), F.count("*").alias("w"))
    places = materialize(_find(occ.select("conv_id", "length", "depth", "tokens", "path_tokens", key), nodes, "node", "w", total), "places")
    mine = F.col("owner") == F.col("conv_id")
    # Of each conversation: its first owned place, the tokens above it, the owner of the place above, whether its end is a leaf of its own.
    convs = places.groupBy("conv_id").agg(
        F.min(F.when(mine, F.col("depth"))).alias("own_from"),
        F.coalesce(F.max(F.when(~mine, F.col("path_tokens"))), F.lit(0)).alias("shared"),
        F.max_by("owner", F.when(~mine, F.col("depth"))).alias("above"),
        F.max(F.when(mine & F.col("childless"), 1).otherwise(0)).cast("long").alias("leaf"),
        F.count("*").alias("w"),
    )
    known = _find(places, materialize(convs, "convs"), "conv_id", "w", total)
    below = F.greatest(F.lit(0).cast("long"), F.col("shared") - (F.col("path_tokens") - F.col("tokens")))
    opens = (F.col("own_from") <= F.col("depth") + 1) & (F.col("length") > F.col("depth"))
    parent = F.when(F.col("depth") > F.col("own_from"), F.col("owner")).otherwise(F.col("above"))
    out = known.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(mine, parent)).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(opens).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(below).alias("saved_tokens"),
    )
    done = ends(occ.filter("depth = length").select(*NODE, "conv_id")).select(key, "ends_sha256")
    joined = out.join(done, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return joined.select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def ordered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, idx (from 0), digest and tokens of the turns, in order; a written table."""
    role_, text_ = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    turns = rows.filter(col(conv).isNotNull()).select(col(conv).cast("long").alias("conv_id"), col(turn).alias("turn"), role_.alias("role"), turn_digest(role_, text_).alias("digest"), F.regexp_count(text_, F.lit(WORD)).cast("long").alias("tokens"), F.monotonically_increasing_id().alias("row"))
    # Written first: range partitioning reads its input twice, and texts should be read once.
    narrow = materialize(turns, "narrow")
    placed = scan(narrow, ["conv_id"], ["turn", "role", "digest", "row"], tag="turns")
    out = materialize(placed.select("conv_id", "idx", "digest", "tokens"), "ordered")
    release(placed, narrow)
    return out


def _roots(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return convs.select("conv_id", "length", zero.alias("depth"), F.lit(b"").alias("digest"), zero.alias("tokens"))


def paths_of(turns: DataFrame) -> DataFrame:
    """The paths of ordered turns as they are, roots included."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    rows = lookup(turns, convs, "conv_id", "length", turns.count())
    return _roots(convs).unionByName(rows.select("conv_id", "length", (F.col("idx") + 1).alias("depth"), "digest", "tokens"))


def rebuilt_paths(turns: DataFrame, heads: Column, every: int = 20, most: int = 3) -> DataFrame:
    """Paths whose first `heads` turns (at most `most`; a Column over conv_id) come from the conversation of the id rounded to a
    multiple of `every`, followed by the conversation's own turns after its first `heads`. turns: written, see `ordered_turns`."""
    total = turns.count()
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    head = turns.filter((F.col("conv_id") % every == 0) & (F.col("idx") < most)).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("idx", "digest", "tokens"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("w")).select("conv_id", "w", heads.cast("long").alias("h"), base)
    # No more conversations share a base than ids round to one.
    taken = F.expr("slice(coalesce(head, array()), 1, cast(h AS int))")
    convs = convs.join(head, "base", "left").withColumn("taken", taken).withColumn("b", F.size("taken").cast("long"))
    convs = materialize(convs.withColumn("length", F.col("b") + F.greatest(F.col("w") - F.col("h"), F.lit(0))).select("conv_id", "w", "h", "b", "length", "taken"), "heads")
    lent = convs.select("conv_id", "length", F.explode("taken").alias("t")).select("conv_id", "length", (F.col("t.idx") + 1).alias("depth"), "t.digest", "t.tokens")
    own = _find(turns, convs.drop("taken"), "conv_id", "w", total).filter("idx >= h")
    rest = own.select("conv_id", "length", (F.col("idx") - F.col("h") + F.col("b") + 1).alias("depth"), "digest", "tokens")
    return _roots(convs).unionByName(lent).unionByName(rest)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Query: the trie of all conversations, each rebuilt on the first turns of its neighbour."""
    turns = ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie(rebuilt_paths(turns, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4))


def _sql() -> str:
    from .merkle import CRC_TABLE, crc_sql

    return rf"""
WITH z AS {CRC_TABLE},
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {crc_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), z),
lent AS (SELECT c.conv_id, 0 AS part, o.i, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.i < c.h),
own AS (SELECT c.conv_id, 1 AS part, o.i, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.i >= c.h),
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM (SELECT * FROM lent UNION ALL SELECT * FROM own)),
p AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS node FROM t
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w FROM p GROUP BY node, depth),
q AS (SELECT p.*, n.conv_id = p.conv_id AS mine, (n.n_convs - 1) * n.w AS saved, lag(p.node) OVER path AS up, lead(p.node) OVER path IS NULL AS ending FROM p JOIN n USING (node, depth) WINDOW path AS (PARTITION BY p.conv_id ORDER BY p.depth)),
links AS (SELECT DISTINCT node, depth, up FROM q),
kids AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM links WHERE depth > 0 GROUP BY up, depth),
own_rows AS (SELECT q.conv_id, q.depth, q.saved, CASE WHEN k.node IS NULL THEN 1 ELSE 0 END AS leaf FROM q LEFT JOIN kids k USING (node, depth) WHERE mine),
sub AS (SELECT p.node, p.depth, sum(r.saved) AS saved_tokens, sum(r.leaf) AS n_leaves FROM p JOIN own_rows r ON r.conv_id = p.conv_id AND r.depth >= p.depth GROUP BY p.node, p.depth),
fin AS (SELECT node, depth, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS e FROM q WHERE ending GROUP BY node, depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, coalesce(fin.e, sha256('')) AS ends_sha256
FROM n JOIN links l ON l.node = n.node AND l.depth = n.depth LEFT JOIN n u ON u.node = l.up AND u.depth = l.depth - 1
LEFT JOIN kids ON kids.node = n.node AND kids.depth = n.depth JOIN sub ON sub.node = n.node AND sub.depth = n.depth LEFT JOIN fin ON fin.node = n.node AND fin.depth = n.depth"""


OP12_SQL = _sql()
