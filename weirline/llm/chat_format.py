"""Chat formatting of reply trees.

Messages name their parent. Root-to-leaf paths are enumerated by self-joins of the message table that
double the distance covered each time: a path of depth d takes about log2(d) rounds, and a round joins
ids only. Branches of a tree are ranked by the mean score of their messages, and each chosen one is
formatted as one conversation.

Template: each turn is `<|im_start|>role\\n` text `<|im_end|>\\n`. Inside roles and texts a backslash is
doubled, and every control string, of this template and of other common ones, gets a backslash after its first
character; a newline in a role becomes `\\N`. Both are undone by `unescape`, so a formatted conversation can
be read back exactly (`read_back`). The loss mask marks the assistants' texts, as code point spans of
the formatted string.

Defined results: null text or role counts as empty; a parent that is missing, null, the message itself or in
another tree makes a root; repeated rows are separate messages (replies to their id go to the one whose role and
text sort first); a message without an id has no replies; ties of scores go to the smaller row number; extra
columns aren't read; an empty table gives an empty result; parents that form a cycle raise ValueError. The best
`keep` branches of a tree are picked by a window that Spark limits before its shuffle, so a tree of many leaves
sends `keep` rows from each task. A conversation is one string
value, so one conversation, not one tree, has to fit in a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, map_arrow, materialize, release

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of this and other public templates (fixed values).
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\N")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "N" else m[1], role)


def format_turns(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        out += [head, body, END]
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest.removesuffix(END))))
    return turns


def _paths(nodes: DataFrame) -> DataFrame:
    """(leaf, node, up) of every root-to-leaf path; nodes: (node, parent or null), written."""
    inner = nodes.filter("parent IS NOT NULL")
    leaves = nodes.join(inner.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    # path: nodes up to 2^k - 1 above each leaf; jump: each node's ancestor 2^k above.
    path = materialize(leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "path")
    jump = materialize(inner.select("node", F.col("parent").alias("to")), "jump")
    step, total = 1, nodes.count()
    while jump.limit(1).count():
        if step > 2 * total:
            raise ValueError("parents form a cycle")
        longer = path.join(jump, "node").select("leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        path_next = materialize(path.unionByName(longer), "path")
        jump_next = materialize(jump.join(jump.select(F.col("node").alias("to"), F.col("to").alias("far")), "to").select("node", F.col("far").alias("to")), "jump")
        release(path, jump)
        path, jump, step = path_next, jump_next, 2 * step
    if path.count() < total and nodes.join(path.select("node"), "node", "left_anti").limit(1).count():
        raise ValueError("parents form a cycle")
    release(jump)
    return path


def reply_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """The best `keep` branches (null: all) of each tree: tree, leaf, place, rank, node.

    messages: a written table with tree, node, parent, score; nodes are unique over all trees.
    """
    known = messages.select(F.col("node").alias("parent"))
    real = messages.filter("parent IS NOT NULL AND parent != node").select("node", "parent").join(known, "parent", "left_semi")
    nodes = materialize(messages.select("node").join(real.select("node", "parent"), "node", "left"), "nodes")
    paths = _paths(nodes).join(messages.select("node", "tree", "score"), "node")
    ends = paths.groupBy("leaf").agg(F.max("up").alias("depth"), F.avg(F.coalesce("score", F.lit(0.0))).alias("mean"), F.first("tree").alias("tree"))
    if keep is not None:
        ranked = ends.withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("mean"), "leaf"))).filter(F.col("rank") <= keep)
    else:
        ranked = ends.withColumn("rank", F.lit(None).cast("int"))
    chosen = ranked.select("leaf", "tree", "depth", "rank")
    return paths.select("leaf", "node", "up").join(chosen, "leaf").select("tree", "leaf", (F.col("depth") - F.col("up")).alias("place"), "rank", "node")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out, masks = [], []
        for turns in batch.column(batch.num_columns - 1):
            text, spans = format_turns([(t["role"] or "", t["text"] or "") for t in turns.as_py()])
            out.append(text)
            masks.append([{"start": s, "end": e} for s, e in spans])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string()), pa.array(masks, span)], names=[*batch.schema.names[:-1], "formatted", "loss_spans"])


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per chosen branch: tree, leaf, rank, formatted, loss_spans. messages: node, role, text."""
    turns = paths.join(messages.select("node", "role", "text"), "node")
    joined = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    kind = paths.schema["tree"].dataType.simpleString()
    return map_arrow(joined.select("tree", "leaf", "rank", "turns"), _format, f"tree {kind}, leaf long, rank int, formatted string, loss_spans array<struct<start: long, end: long>>")


def format_chats(messages: DataFrame, tree: str = "tree_id", node: str = "message_id", parent: str = "parent_id", role: str = "role", text: str = "text", score: str | None = "score", keep: int | None = 1) -> DataFrame:
    """The best branches of each tree as conversations: tree, leaf (its message id), rank, formatted, loss_spans."""
    value = col(score).cast("double") if score else F.lit(0.0)
    picked = messages.select(col(tree).alias("tree"), col(node).cast("long").alias("id"), col(parent).cast("long").alias("parent_id"), col(role).cast("string").alias("role"), col(text).cast("string").alias("text"), value.alias("score"))
    # Rows are numbered, for ids may be null or repeated, or the same in several trees.
    rows = materialize(picked.withColumn("node", F.monotonically_increasing_id()), "rows")
    named = rows.filter("id IS NOT NULL").groupBy("tree", "id").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "node")).getField("node").alias("parent"))
    named = named.select(F.col("tree").alias("in_tree"), F.col("id").alias("parent_id"), "parent")
    linked = rows.filter("parent_id IS NOT NULL AND NOT (parent_id <=> id)").join(named, "parent_id").filter("tree <=> in_tree").select("node", "parent")
    whole = materialize(rows.join(linked, "node", "left"), "messages")
    out = format_paths(reply_paths(whole, keep), whole)
    return out.join(rows.select(F.col("node").alias("leaf"), "id"), "leaf").select("tree", F.col("id").alias("leaf"), "rank", "formatted", "loss_spans")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, formatted, loss_spans: what the formatted string says."""
    for batch in batches:
        rows = []
        for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = read_back(formatted)
            masked = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            digest = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((len(turns), digest(whole), len(masked), digest(masked), len(formatted)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def conversation_messages(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as reply chains, a written table. Rows of a conversation follow
    by turn, then role and text; nodes are numbered without gathering a conversation in a driver."""
    order: list[Column] = [F.col("turn"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), F.col("row")]
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    numbered = materialize(numbered, "turns")
    link = numbered.select(F.col("conv_id").alias("tree"), F.col("row").alias("node"), F.lag("row").over(W.partitionBy("conv_id").orderBy(*order)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
    return materialize(link, "messages")


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    """Query: all conversations, each a chain of replies, and conversation -1 of control strings."""
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    messages = conversation_messages(rows)
    # Each conversation is a chain, so its one branch is its best one.
    formatted = format_paths(reply_paths(messages, keep=1), messages)
    out = formatted.select(F.col("tree").alias("conv_id"), "formatted", "loss_spans")
    return map_arrow(out, _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


OP1_SQL = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(role) + length(regexp_replace(role, '[^\\\n]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
             + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
             + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) + 24 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
