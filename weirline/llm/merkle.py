"""Merkle dataset manifest: a proof for every row, by distributed block reduction and a broadcast upper tree.

A leaf is the digest of a row's fields; the leaves of a group, by id, are the nodes of a tree in which every FAN
consecutive nodes make one, and the groups' roots, by group, are the nodes of the tree above. Leaves are dealt as blocks
of FAN * FAN (`_ranks.scan` gives their places, so no task holds a group). Blocks are reduced to one node each, in the
JVM, again and again until at most TOP nodes are left; the driver builds the tree above those and broadcasts
the rest of each node's path. Going back down, a block's task adds the siblings inside the block, which
finishes the paths of its rows, and folds each row's leaf (or the one that the row claims now) up to the root.
Where the groups are too many for the driver, their roots are numbered and reduced in blocks as well.

A path is an array of steps from the leaf to the root, each of the siblings to the left and to the right as one string
of hex digests; a step without siblings still hashes the node alone, as its run does.

Defined results: fields that are null are `-`; null ids come first, then by id; rows of equal id are ordered by their
leaf, and equal rows share leaf and, by place, differ in siblings; a null group is a group of its own, before the others;
a group of one row has its leaf as its root, and a table of one group has that group's root; texts of any length are
hashed whole; other columns aren't read, whatever their names; an empty table gives an empty result. TOP bounds what the driver and
a broadcast hold: TOP paths of at most 6 steps of 15 siblings, 24 MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import col, map_arrow, materialize, release
from ._ranks import scan
from .exact_dedup import fold_ascii

#: Nodes of a run; nodes of a block: two levels of runs.
FAN = 16
BLOCK = FAN * FAN
#: Nodes the driver builds the upper tree from.
TOP = 4096
#: Columns of the documents that a leaf covers, in order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

Step = tuple[str, str]
PATH = "array<struct<left: string, right: string>>"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(c: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def climb(nodes: list[str]) -> tuple[str, list[list[Step]]]:
    """The root of a sequence of nodes and each node's steps up to it."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    paths: list[list[Step]] = [[]]
    for below in reversed(levels[:-1]):
        wider = []
        for i, _ in enumerate(below):
            start = i // FAN * FAN
            wider.append([("".join(below[start:i]), "".join(below[i + 1 : start + FAN])), *paths[i // FAN]])
        paths = wider
    return levels[-1][0], paths


def block_steps(digests: list[str], whole: bool) -> list[list[Step]]:
    """Each node's steps inside its block; whole: the block is all that its tree has, so it ends at the root."""
    _, paths = climb(digests)
    depth = len(paths[0])
    if not whole and depth < 2:
        # The block is the short last one of a longer tree: its runs go up two levels all the same.
        paths = [[*p, *[("", "")] * (2 - depth)] for p in paths]
    return paths


def fold(leaf: str, steps: list[Step]) -> str:
    for left, right in steps:
        leaf = sha(left + leaf + right)
    return leaf


def _reduced(blocks: DataFrame) -> Column:
    """The node that a block becomes. The only block of a tree stops at one node; others go up two levels."""
    hexes = F.transform("members", lambda m: F.lower(F.hex(m["digest"])))
    n = F.size("members")
    run = lambda i: F.sha2(F.array_join(F.slice(hexes, i * FAN + 1, FAN), ""), 256)
    runs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / FAN).cast("int")), run)
    alone = F.col("idx") == 0
    return F.when(alone & (n == 1), F.col("members")[0]["digest"]).when(alone & (n <= FAN), F.unhex(runs[0])).otherwise(F.unhex(F.sha2(F.array_join(runs, ""), 256)))


def _pack(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """nodes (tree, idx, digest and the carried columns) as blocks (tree, idx, members, digest), written."""
    block = F.expr(f"idx div {BLOCK}").alias("block")
    packed = nodes.select("tree", block, F.struct("idx", "digest", *carried).alias("member")).groupBy("tree", "block").agg(F.collect_list("member").alias("members"))
    # idx comes first and is unique in its block, so it alone settles the order.
    ordered = packed.select("tree", F.col("block").alias("idx"), F.sort_array("members").alias("members"))
    return materialize(ordered.withColumn("digest", _reduced(ordered)), "blocks")


def _paths_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (tree, idx, members, sub, path) to their members: tree, idx, sub, path."""
    for batch in batches:
        trees, ids, subs, paths = [], [], [], []
        for r in batch.to_pylist():
            members, above = r["members"], [(s["left"], s["right"]) for s in r["path"]]
            inner = block_steps([m["digest"].hex() for m in members], r["idx"] == 0 and len(members) < BLOCK)
            for m, steps in zip(members, inner, strict=True):
                trees.append(r["tree"])
                ids.append(m["idx"])
                subs.append(r["sub"])
                paths.append([{"left": a, "right": b} for a, b in (*steps, *above)])
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(ids, pa.int64()), pa.array(subs, pa.string()), pa.array(paths, _PATH_ARROW)], names=["tree", "idx", "sub", "path"])


_PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

#: Rows' results from a block: its ids, leaves (hex), claimed leaves (hex or None), sub-root, steps of each row, root.
Emit = Callable[[list[str], list[str | None], str, list[list[Step]], str], list[list]]


def _emit_paths(leaves: list[str], claimed: list[str | None], sub: str, steps: list[list[Step]], root: str) -> list[list]:
    n = len(leaves)
    return [leaves, [sub] * n, [root] * n, [[{"left": a, "right": b} for a, b in p] for p in steps]]


def _emit_digests(leaves: list[str], claimed: list[str | None], sub: str, steps: list[list[Step]], root: str) -> list[list]:
    n = len(leaves)
    proofs = [sha("".join(a + b for a, b in p)) for p in steps]
    folded = [fold(c or leaf, p) for leaf, c, p in zip(leaves, claimed, steps, strict=True)]
    return [leaves, [sub] * n, [root] * n, proofs, folded, [f == root for f in folded]]


#: What can be asked for of each row: the emitter and its columns.
OUTPUTS: dict[str, tuple[Emit, list[tuple[str, str, pa.DataType]]]] = {
    "paths": (_emit_paths, [("leaf", "string", pa.string()), ("subroot", "string", pa.string()), ("root", "string", pa.string()), ("path", PATH, _PATH_ARROW)]),
    "digests": (_emit_digests, [("leaf", "string", pa.string()), ("subroot", "string", pa.string()), ("root", "string", pa.string()), ("proof_sha256", "string", pa.string()), ("folded_root", "string", pa.string()), ("verified", "boolean", pa.bool_())]),
}


def _rows_down(root: str, emit: Emit, kinds: list[tuple[str, str, pa.DataType]], id_name: str):
    """Leaf blocks (idx, members, sub, path) to rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(batch.schema.get_field_index("members"))
            for k in range(batch.num_rows):
                part = members.slice(k, 1).flatten()
                leaves = [d.hex() for d in part.field("digest").to_pylist()]
                claimed = [d.hex() if d is not None else None for d in part.field("claimed").to_pylist()]
                above = [(s["left"], s["right"]) for s in batch.column("path")[k].as_py()]
                steps = [[*p, *above] for p in block_steps(leaves, batch.column("idx")[k].as_py() == 0 and len(leaves) < BLOCK)]
                out = emit(leaves, claimed, batch.column("sub")[k].as_py(), steps, root)
                yield pa.RecordBatch.from_arrays([part.field("id"), *(pa.array(v, t) for v, (_, _, t) in zip(out, kinds, strict=True))], names=[id_name, *(name for name, _, _ in kinds)])

    return run


def _on(blocks: DataFrame, paths: DataFrame, small: bool) -> DataFrame:
    """Blocks with their node's path and sub-root: one row a block, so this join is 1 / BLOCK of the rows' size."""
    return blocks.drop("digest").join(F.broadcast(paths) if small else paths, ["tree", "idx"])


class Tree:
    """The manifest's tree over written leaf blocks."""

    def __init__(self, leaves: DataFrame, top: int):
        """leaves: tree (a non-null text whose order is the groups'), idx, digest, id, claimed."""
        self.spark, self.top = leaves.sparkSession, top
        self.leaf_blocks = _pack(leaves, ["id", "claimed"])
        self.root, self.paths, self.small = None, None, True
        node = lambda b: b.select("tree", "idx", "digest")
        trees = self.leaf_blocks.select("tree").distinct().count()
        if not trees:
            return
        rounds, nodes = self._reduce(node(self.leaf_blocks), trees)
        above, names = [], None
        if nodes.count() > top:
            # Each group is one node now: their roots are one long sequence.
            names = scan(nodes.withColumns({"sub": F.lower(F.hex("digest")), "all": F.lit("")}).select("all", "tree", "sub", "digest"), ["all"], ["tree"], tag="roots")
            above, nodes = self._reduce(names.select(F.lit("").alias("tree"), "idx", "digest"), 1)
        self.root, paths = self._upper([(r["tree"], r["idx"], r["digest"].hex()) for r in nodes.collect()])
        schema = f"tree string, idx long, sub string, path {PATH}"
        self.paths = self.spark.createDataFrame([(t, i, s, [{"left": a, "right": b} for a, b in p]) for t, i, s, p in paths], schema)
        for blocks in reversed(above):
            self._descend(blocks, schema)
        if names is not None:
            own = names.select(F.col("tree").alias("of"), "idx", F.col("sub").alias("own")).join(self.paths.select("idx", "path"), "idx")
            self.paths, self.small = own.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("idx"), F.col("own").alias("sub"), "path"), False
        for blocks in reversed(rounds):
            self._descend(blocks, schema)

    def _reduce(self, nodes: DataFrame, trees: int) -> tuple[list[DataFrame], DataFrame]:
        """Rounds of blocks until at most `top` nodes are left, or one a tree."""
        rounds, n = [], nodes.count()
        while n > self.top and n > trees:
            rounds.append(_pack(nodes, []))
            nodes = rounds[-1].select("tree", "idx", "digest")
            n = nodes.count()
        return rounds, nodes

    @staticmethod
    def _upper(nodes: list[tuple[str, int, str]]) -> tuple[str, list[tuple[str, int, str, list[Step]]]]:
        """The root over at most `top` nodes (tree, idx, digest) and their paths."""
        groups: dict[str, list[tuple[int, str]]] = {}
        for tree, idx, digest in nodes:
            groups.setdefault(tree, []).append((idx, digest))
        order = sorted(groups, key=lambda t: t.encode("utf-8", "surrogatepass"))
        built = {t: climb([d for _, d in sorted(groups[t])]) for t in order}
        root, above = climb([built[t][0] for t in order])
        return root, [(t, i, built[t][0], [*p, *up]) for t, up in zip(order, above, strict=True) for i, p in enumerate(built[t][1])]

    def _descend(self, blocks: DataFrame, schema: str) -> None:
        self.paths = materialize(map_arrow(_on(blocks, self.paths, self.small), _paths_down, schema), "paths")
        self.small = False
        release(blocks)

    def rows(self, output: str, id_name: str) -> DataFrame:
        emit, kinds = OUTPUTS[output]
        kind = self.leaf_blocks.schema["members"].dataType.elementType["id"].dataType.simpleString()
        schema = ", ".join([f"`{id_name}` {kind}", *(f"{name} {t}" for name, t, _ in kinds)])
        if self.root is None:
            return self.spark.createDataFrame([], schema)
        joined = _on(self.leaf_blocks, self.paths, self.small).select("idx", "members", "sub", "path")
        return map_arrow(joined, _rows_down(self.root, emit, kinds, id_name), schema)


def manifest(docs: DataFrame, fields: list[str] | None = None, id_col: str = "doc_id", group_col: str = "source", claims: dict[str, Column] | None = None, claimed: Column | None = None, output: str = "paths", top: int = TOP) -> DataFrame:
    """A row for each row of docs: id_col, leaf, subroot, root (hex) and, with output="paths", the path to the root;
    with "digests" the digest of all siblings, the root folded from what the row claims, and whether it is the root.

    claims: the columns that rows may hold now in place of their fields; claimed: for which rows they do so (all, if
    omitted). The others fold their own leaf. top: see TOP.
    """
    fields = fields or FIELDS
    now = claims or {}
    other = leaf_digest([now.get(f, col(f)) for f in fields])
    leaf = leaf_digest([col(f) for f in fields])
    changed = F.lit(None).cast("binary") if not now else other if claimed is None else F.when(claimed, other)
    group = F.when(col(group_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), col(group_col).cast("string")))
    # Written first: range partitioning reads its input twice, and texts should be read once.
    leaves = docs.select(group.alias("tree"), col(id_col).alias("id"), leaf.alias("digest"), changed.alias("claimed"), F.monotonically_increasing_id().alias("salt"))
    narrow = materialize(leaves, "leaves")
    placed = scan(narrow, ["tree"], ["id", "digest", "salt"], tag="placed")
    tree = Tree(placed.drop("salt"), top)
    release(placed, narrow)
    return tree.rows(output, id_col)


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Query: every row of documents with its leaf, roots, proof and the root folded after tampering."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(F.col("text").isNotNull(), fold_ascii(F.col("text")))
    return manifest(docs, claims={"text": text}, claimed=tampered, output="digests")


#: CRC-32 of an ASCII text in SQL, by the table of its polynomial (fixed value).
CRC_TABLE = "(SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, where `t` is CRC_TABLE's list."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


#: Levels that the SQL spells out: 16**7 rows of a source, 16**5 sources.
_LEVELS, _ABOVE = 7, 5


def _sql() -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def levels(first: str, name: str, by: str, count: int) -> list[str]:
        out = [first]
        for k in range(count):
            run = f"PARTITION BY {by}idx // {FAN} ORDER BY idx ROWS BETWEEN"
            out.append(f"{name}{k}s AS (SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {name}{k})")
            out.append(f"{name}{k + 1} AS (SELECT {by}idx // {FAN} AS idx, max(n + {FAN - 1}) // {FAN} AS n, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {name}{k} GROUP BY {by}idx // {FAN})")
        return out

    tampered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(map(field, FIELDS))
    bad = " || ".join(field(tampered if f == "text" else f) for f in FIELDS)
    ctes = [
        f"z AS {CRC_TABLE}",
        f"d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree, sha256({leaf}) AS leaf, CASE WHEN {crc_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({bad}) ELSE sha256({leaf}) END AS seen FROM documents, z)",
        "r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d)",
        *levels("l0 AS (SELECT tree, idx, n, leaf AS h FROM r)", "l", "tree, ", _LEVELS),
        f"subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS seat, count(*) OVER () AS m FROM l{_LEVELS})",
        *levels("u0 AS (SELECT seat AS idx, m AS n, subroot AS h FROM subs)", "u", "", _ABOVE),
    ]
    node, joins, proof = "seen", "", "''"
    ctes.append("f0 AS (SELECT r.doc_id, r.leaf, s.subroot, r.tree, r.idx, s.seat, r.seen AS node, '' AS proof FROM r JOIN subs s USING (tree))")
    step = "CASE WHEN x.n > 1 THEN sha256(x.a || f.node || x.b) ELSE f.node END AS node, f.proof || x.a || x.b AS proof"
    for k in range(_LEVELS + _ABOVE):
        if k < _LEVELS:
            on = f"l{k}s x ON x.tree = f.tree AND x.idx = f.idx // {FAN**k}"
        else:
            on = f"u{k - _LEVELS}s x ON x.idx = f.seat // {FAN ** (k - _LEVELS)}"
        ctes.append(f"f{k + 1} AS (SELECT f.doc_id, f.leaf, f.subroot, f.tree, f.idx, f.seat, {step} FROM f{k} f JOIN {on})")
    last = _LEVELS + _ABOVE
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = u.h AS verified FROM f{last}, u{_ABOVE} u"


OP11_SQL = _sql()
