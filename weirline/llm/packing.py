"""Vector best-fit packing into sequences.

An item has three sizes: tokens, one document, and its attention cost (tokens squared). A bin has a
capacity for each. Items are placed the longest first: of the open bins where one fits under every constraint
it goes to the bin that leaves the smallest weighted norm of the three residuals (or, by choice, the one whose
residuals have the largest weighted dot-product with its sizes). Since an item is its token count, items of a
length are interchangeable, and so are bins of equal residuals: both are counted, at most `capacity` lengths
reach the driver, whatever the data, and one decision places as many items as there are bins of that kind. The
plan is broadcast; items find their place in it by their length and their rank among items
of that length. Ranks are dealt by (length, salt), so a length that a third of all items share is no hot key.

Defined results: null text counts as empty and still has the closing id; repeated rows are packed each;
ids may be null; lengths over the capacity are cut by the caller; a capacity that no item fits raises
ValueError. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, map_arrow, materialize

#: Tokens in a sequence, and the id that closes a document, of the registered query.
CAPACITY, CLOSE = 4096, 1
#: Weights of the residual tokens, documents and cost, and the rule that selects bins.
WEIGHTS, RULE = (1.0, 0.05, 0.05), "norm"
#: Words whose ids a worker remembers at most; it forgets those that it met least recently.
CACHE_WORDS = 200_000
#: Longest word that is remembered.
CACHE_CHARS = 64
#: Texts, and bytes of them, whose words are looked up together.
TOGETHER, TOGETHER_BYTES = 2048, 4 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


#: Characters stripped from a word's end before it is looked up: ASCII marks, which the tokenizer cuts from letters before them.
TAIL = string.punctuation


def _byte_letters() -> dict[int, str]:
    """The letters that a byte-level vocabulary writes bytes as: printable ones stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _as_model_word(word: str) -> str | None:
    """What the tokenizer's normalisation and pre-tokenization make of a word of Latin letters; None for others."""
    if not word.isalpha():
        return None
    if word.isascii():
        return word.lower()
    if max(word) > "\u017f" or "\u0130" in word:
        return None
    low = word.lower()
    return low if low.isascii() else low.encode().decode("latin-1").translate(_LETTERS)


class _Recent:
    """Ids by word, of the words of late: a full generation becomes the old one, from which words that come again are taken over."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most // 2, {}, {}

    def age(self) -> None:
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new

    def get(self, word: str) -> bytes | None:
        ids = self.new.get(word)
        if ids is None and (ids := self.old.get(word)) is not None:
            self.new[word] = ids
        return ids

    def put(self, word: str, ids: bytes) -> None:
        # Long words (in scripts without spaces a text is one) are not held: the cache is bounded in bytes, too.
        if len(word) <= CACHE_CHARS:
            self.new[word] = ids


@lru_cache(maxsize=1)
def _held(path: str) -> tuple[_Recent, _Recent]:
    """By what the model takes for a word, and by other words as they stand: a name of the one may be one of the other."""
    return _Recent(CACHE_WORDS), _Recent(CACHE_WORDS // 4)


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _ids_of(words: list[str], path: str) -> list[bytes]:
    """The ids of each of these different words. A plain word and the marks at its end are looked up apart."""
    tokenizer, (plain, others) = _tokenizer(path), _held(path)
    plain.age()
    others.age()
    out, hard, fresh, tokenize = [], [], plain.new, tokenizer.model.tokenize
    for w in words:
        # A lower-case ASCII word is what the model takes it for.
        if (ids := fresh.get(w)) is not None and w.isascii():
            out.append(ids)
            continue
        core = w.rstrip(TAIL)
        model_word = _as_model_word(core) if core else None
        if model_word is None:
            if (ids := others.get(w)) is None:
                hard.append(len(out))
            out.append(ids)
            continue
        if (ids := fresh.get(model_word)) is None and (ids := plain.get(model_word)) is None:
            ids = _packed_ids([t.id for t in tokenize(model_word)])
            plain.put(model_word, ids)
        if len(core) < len(w):
            tail = w[len(core) :]
            if (marks := fresh.get(tail)) is None and (marks := plain.get(tail)) is None:
                marks = _packed_ids(tokenizer.encode(tail, add_special_tokens=False).ids)
                plain.put(tail, marks)
            ids += marks
        out.append(ids)
    for at in range(0, len(hard), 4096):
        part = hard[at : at + 4096]
        for k, e in zip(part, tokenizer.encode_batch_fast([words[k] for k in part], add_special_tokens=False), strict=True):
            out[k] = _packed_ids(e.ids)
            others.put(words[k], out[k])
    return out


def _encoded(texts: pa.Array, path: str) -> list[bytes]:
    words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
    kinds = words.flatten().dictionary_encode()
    ids = _ids_of(kinds.dictionary.to_pylist(), path)
    sizes, kind = np.fromiter(map(len, ids), np.int64, len(ids)) // 4, kinds.indices.to_numpy()
    flat, n = np.frombuffer(b"".join(ids), "<u4"), sizes[kind]
    ends = np.concatenate(([0], np.cumsum(n)))
    # A word's ids stand in `flat` where those of its kind do.
    places = np.repeat((np.cumsum(sizes) - sizes)[kind] - ends[:-1], n)
    places += np.arange(ends[-1])
    every, cuts = flat[places], ends[words.offsets.to_numpy()]
    return [every[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def encode_texts(texts: pa.Array, path: str) -> Iterator[bytes]:
    """Ids (little-endian, 32 bits) of each text, null as empty, as the tokenizer gives them.

    The tokenizer drops white space and no token crosses it, so words between spaces are encoded apart,
    those of many texts together and each once as long as it is remembered.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        most = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TOGETHER_BYTES, side="right"))
        stop = min(start + TOGETHER, max(start + 1, most))
        yield from _encoded(texts.slice(start, stop - start), path)
        start = stop


# ---- The plan: which lengths share a bin.


class Plan:
    """For each length, where its items of a rank go: rows of (first rank, first bin, offset) by rank."""

    def __init__(self):
        self.entries: dict[int, list[tuple[int, int, int]]] = {}
        self.used: dict[int, int] = {}
        self.bins = 0
        #: What is left of bins that are not full (tokens, documents, cost): runs of such bins.
        self.open: dict[tuple[int, int, int], list[tuple[int, int]]] = {}

    def add(self, length: int, times: int, first_bin: int, offset: int) -> None:
        """The next `times` items of a length, one in each of the bins from first_bin on."""
        rank = self.used.get(length, 0)
        self.entries.setdefault(length, []).append((rank, first_bin, offset))
        self.used[length] = rank + times

    def freeze(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for n, rows in self.entries.items()}


class _Open:
    """Open bins by what is left of their tokens, documents and cost: for each such residual, runs of bins
    (first, how many). Residuals are kept as rows of an array, so that all are scored at once."""

    def __init__(self):
        self.rows, self.live = np.zeros((64, 3), np.int64), np.zeros(64, bool)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(64)]
        self.place: dict[tuple[int, int, int], int] = {}
        self.free = list(range(63, -1, -1))

    def put(self, residual: tuple[int, int, int], first: int, n: int) -> None:
        k = self.place.get(residual)
        if k is None:
            if not self.free:
                size = len(self.live)
                self.free = list(range(2 * size - 1, size - 1, -1))
                self.rows, self.live = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.live, np.zeros_like(self.live)])
                self.runs += [[] for _ in range(size)]
            k = self.place[residual] = self.free.pop()
            self.rows[k], self.live[k] = residual, True
        self.runs[k].append((first, n))

    def take(self, k: int, most: int) -> list[tuple[int, int]]:
        """Up to `most` bins of a residual, as runs."""
        out, runs = [], self.runs[k]
        while runs and most:
            first, n = runs.pop()
            m = min(n, most)
            if m < n:
                runs.append((first + m, n - m))
            out.append((first, m))
            most -= m
        if not runs:
            del self.place[tuple(self.rows[k].tolist())]
            self.live[k] = False
            self.free.append(k)
        return out


def _most(residual: tuple[int, int, int], n: int) -> int:
    """How many items of length n fit what is left."""
    tokens, docs, cost = residual
    return min(tokens // n, docs, cost // (n * n))


def _place(plan: Plan, open_: _Open, residual: tuple[int, int, int], n: int, first: int, bins: int, each: int, capacity: int) -> int:
    """Put `each` items of length n in each of these bins, which go on with what is left; how many items that were."""
    tokens, docs, cost = residual
    if bins and each:
        for j in range(each):
            plan.add(n, bins, first, capacity - tokens + j * n)
        after = tokens - each * n, docs - each, cost - each * n * n
        if after[0] and after[1]:
            open_.put(after, first, bins)
    return bins * each


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = RULE) -> Plan:
    """Places for the items counted by length, the longest first, under the capacities of tokens, documents and cost.

    Of the open bins where an item fits under every constraint, it goes to the one that leaves the smallest weighted
    norm of the three residuals (rule norm), or whose residuals have the largest weighted dot-product with its sizes
    (rule dot), each as a share of its capacity; a new bin is opened where none fits.
    """
    max_docs, max_cost = max_docs or capacity, max_cost or capacity * capacity
    if rule not in ("dot", "norm"):
        raise ValueError(f"rule must be dot or norm, not {rule!r}")
    if any(n > capacity or n * n > max_cost or n < 1 for n in counts):
        raise ValueError("an item fits no bin")
    scale = np.array(weights) / np.array([capacity, max_docs, max_cost], float) ** 2
    plan, open_ = Plan(), _Open()
    for n in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        left, size = counts[n], np.array([n, 1, n * n])
        while left:
            fits = np.flatnonzero(open_.live & (open_.rows >= size).all(axis=1))
            if not len(fits):
                # New bins, one after the other: each is the only one that fits until it is full.
                residual, take = (capacity, max_docs, max_cost), [(plan.bins, -(-left // _most((capacity, max_docs, max_cost), n)))]
                plan.bins += take[0][1]
            else:
                rest = open_.rows[fits]
                score = ((rest - size) ** 2 * scale).sum(axis=1) if rule == "norm" else -(rest * size * scale).sum(axis=1)
                k = int(fits[np.lexsort((rest[:, 2], rest[:, 0], score))[0]])
                residual = tuple(open_.rows[k].tolist())
                take = None
            # A bin that got an item has a smaller norm than before, so the next item goes there as well, until none fits; by the
            # product it comes after the others of its kind, so each of those gets one before all are scored again.
            each = _most(residual, n) if rule == "norm" or take or not any(weights) else 1
            for first, m in take or open_.take(k, -(-left // each)):
                full = min(m, left // each)
                left -= _place(plan, open_, residual, n, first, full, each, capacity)
                if full < m:
                    left -= _place(plan, open_, residual, n, first + full, 1, left, capacity)
    plan.open = {residual: open_.runs[k] for residual, k in open_.place.items()}
    return plan


def plan_groups(counts: dict[tuple[str, int], int], capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = RULE) -> tuple[dict, dict[int, tuple[int, int]]]:
    """A plan for each group (keys are group, length), and what joins them: by bin, the bin that it goes into and how far.

    A bin holds one group. Only a group's bin that is half full at most goes, whole, into the fullest bin of any group where it
    fits, so that groups cost few bins more than one plan for all would.
    """
    by: dict[str, dict[int, int]] = {}
    for (group, n), c in counts.items():
        by.setdefault(group, {})[n] = c
    full = (capacity, max_docs or capacity, max_cost or capacity * capacity)
    entries, rest, small, base = {}, {}, [], 0
    for group in sorted(by):
        plan = plan_bins(by[group], capacity, max_docs, max_cost, weights, rule)
        for n, (rank, first, offset) in plan.freeze().items():
            entries[group, n] = rank, first + base, offset
        for left, runs in plan.open.items():
            if 2 * left[0] < capacity:
                rest.setdefault(left, []).append(base + runs[0][0])
            else:
                small += [(left, base + first + k) for first, n in runs for k in range(n)]
        base += plan.bins
    moved: dict[int, tuple[int, int]] = {}
    for left, bin_ in sorted(small):
        need = tuple(a - b for a, b in zip(full, left, strict=True))
        fits = [r for r in rest if all(a >= b for a, b in zip(r, need, strict=True))]
        if not fits:
            rest.setdefault(left, []).append(bin_)
            continue
        best = min(fits)
        host = rest[best].pop()
        if not rest[best]:
            del rest[best]
        moved[bin_] = host, capacity - best[0]
        rest.setdefault(tuple(a - b for a, b in zip(best, need, strict=True)), []).append(host)
    return entries, moved


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = RULE, salts: int | None = None, group_col: str | None = None) -> DataFrame:
    """items with sequence_id and offset, in place of columns of these names. Items are read several times: pass a
    written table. group_col: items of different values (null is one) share a sequence only as `plan_groups` says."""
    items = items.drop("sequence_id", "offset")
    spark = items.sparkSession
    total = items.count()
    salts = salts or max(8, total // 1_000_000)
    own = {"group": "__wl_group", "length": "__wl_length", "salt": "__wl_salt", "row": "__wl_row", "rank": "__wl_rank", "base": "__wl_base"}
    group = F.concat(F.lit("="), col(group_col).cast("string")) if group_col else F.lit("")
    rows = items.select("*", F.coalesce(group, F.lit("")).alias(own["group"]), col(length_col).cast("long").alias(own["length"]), F.pmod(F.xxhash64(*[col(c) for c in items.columns]), F.lit(salts)).alias(own["salt"]))
    # Rank in (group, length, salt), on top of the counts of the salts before: rows of one length are dealt to all salts.
    kinds = [own["group"], own["length"]]
    sizes = materialize(rows.groupBy(*kinds, own["salt"]).agg(F.count("*").alias("n")), "sizes")
    counts = {(r[0], r[1]): r[2] for r in sizes.groupBy(*kinds).agg(F.sum("n")).collect()}
    entries, moved = plan_groups(counts, capacity, max_docs, max_cost, weights, rule)
    gone = np.array(sorted(moved), np.int64)
    shared = spark.sparkContext.broadcast((entries, gone, np.array([moved[k] for k in gone.tolist()], np.int64).reshape(-1, 2)))
    before = W.partitionBy(*kinds).orderBy(own["salt"]).rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.withColumn(own["base"], F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = W.partitionBy(*kinds, own["salt"]).orderBy(*[col(c) for c in items.columns])
    ranked = rows.withColumn(own["row"], F.row_number().over(inside) - 1).join(bases, [*kinds, own["salt"]])
    ranked = ranked.select(*[col(c) for c in items.columns], F.col(own["group"]), F.col(own["length"]), (F.col(own["row"]) + F.col(own["base"])).cast("long").alias(own["rank"]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, gone, to = shared.value
        for batch in batches:
            groups, lengths, ranks = batch.column(batch.num_columns - 3).dictionary_encode(), batch.column(batch.num_columns - 2).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            held = groups.indices.to_numpy()
            for g, name in enumerate(groups.dictionary.to_pylist()):
                of = np.flatnonzero(held == g)
                for n in np.unique(lengths[of]):
                    at = of[lengths[of] == n]
                    first, bin_, offset = entries[name, int(n)]
                    k = np.searchsorted(first, ranks[at], side="right") - 1
                    bins[at], offsets[at] = bin_[k] + ranks[at] - first[k], offset[k]
            if len(gone):
                k = np.minimum(np.searchsorted(gone, bins), len(gone) - 1)
                hit = gone[k] == bins
                offsets[hit] += to[k[hit], 1]
                bins[hit] = to[k[hit], 0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(bins), pa.array(offsets)], names=[*batch.schema.names[:-3], "sequence_id", "offset"])

    from pyspark.sql import types as T

    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(ranked, place, schema)


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, close: int | None = CLOSE, with_ids: bool = False, group_col: str | None = None) -> DataFrame:
    """Texts as pieces of at most `capacity` tokens: id_col, piece, start, length, ids_crc32 and, if asked
    for, ids (array<int>) and group_col. Only longer texts are cut."""
    from pyspark.sql.pandas.types import to_arrow_type

    path = tokenizer or default_tokenizer()
    picked = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), *([col(group_col).cast("string").alias("group")] if group_col else []))
    kind = picked.schema["id"].dataType
    end = b"" if close is None else np.array([close], dtype="<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                owner, piece, length, crc, ids = [], [], [], [], []
                for k, data in enumerate(encode_texts(part.column(1), path)):
                    data += end
                    for j in range(0, max(len(data), 1) if len(data) else 0, width):
                        cut = data[j : j + width]
                        owner.append(k)
                        piece.append(j // width)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            ids.append(np.frombuffer(cut, dtype="<u4").astype(np.int32))
                piece = np.array(piece, dtype=np.int64)
                arrays = [part.column(0).take(pa.array(owner, pa.int64())).cast(to_arrow_type(kind)), pa.array(piece, pa.int32()), pa.array(piece * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                if group_col:
                    arrays.append(part.column(2).take(pa.array(owner, pa.int64())).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, *["group"] * bool(group_col)])

    schema = f"id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + ", group string" * bool(group_col)
    out = map_arrow(picked, run, schema).withColumnRenamed("id", id_col)
    return out.withColumnRenamed("group", group_col) if group_col else out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, group_col: str | None = None, **options) -> DataFrame:
    """Pieces of all texts with the sequence and the place there that each is given; group_col: see `pack`."""
    pieces = materialize(tokenize_pieces(docs, id_col, text_col, capacity=capacity, group_col=group_col), "pieces")
    return pack(pieces, capacity=capacity, group_col=group_col, **options)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all documents packed into sequences of at most 4096 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
