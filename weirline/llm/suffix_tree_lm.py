"""Language-model scoring by a probabilistic suffix tree over words.

Tokens are words, then one end. A node of the tree is a context: the last one, two, ... tokens before a
symbol. Of a context's next symbols those seen MIN_COUNT times after it are kept, each count less a discount;
what is left of the mass goes to the distribution of the context's suffix, down to add-one unigrams (interpolated
absolute discounting), so every state's distribution sums to one over all known words and one unknown. A context
stays if its next-symbol distribution diverges from that of its suffix by at least MIN_DIVERGENCE (relative
entropy, in nats), or if a longer context that stays needs it. A text is scored from the longest state that is
a suffix of what precedes each token.

Counts, not shares, decide what is kept, so the tree grows with the data. A gram is a context with its symbol,
named by a 64-bit hash of its tokens; buckets of grams are owned by tasks (see `_packed`), and what a gram needs
to know of its context and of its suffix it asks their owners. A kept gram's suffix is kept too, so a score is
the base score plus one value for each gram of the text that is in the tree: an entry's value is its log
probability less that of its suffix and less its context's weight, a context's value is its weight. Texts ask the
owners for the values of their grams, a chunk of texts at a time, and get sums by text back. The MOST most
frequent words and grams are broadcast instead, and bitmaps of fixed size keep grams that can't be in the tree from
being asked for; neither changes the result. An owner gets a gram once from each chunk of texts, however often the chunk
has it, so no key is hot.

Defined results: null text counts as empty (one token, the end); a null id counts as the text '' when texts are
held out; repeated rows give repeated result rows; without training texts N and V are zero, and the model
is the base. An empty table gives an empty result. Extra columns are not read. A long text is counted in windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col, id_text, map_arrow, release, stable
from ._packed import Mail, Row, addressed, buckets, deal, drop, fetch, find, kind_of, owners, pack, send, step, unpack

#: Least relative entropy of a context to its suffix, longest context, and discount of a kept count.
MIN_DIVERGENCE, DEPTH, DISCOUNT = 0.01, 2, 0.5
#: Least count of a context with its symbol.
MIN_COUNT = 2
#: Words, and grams, that are broadcast: at most so many of the most frequent.
MOST = 1 << 18
#: Multiplier of the hashes of words and of grams: any odd number.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: Bits of a filter's place (2 ** 27 bits are 16 MB).
FILTER_BITS = 27
#: Bytes of text tokenised at once, tokens in a window, and entries that a task gathers before it sends them.
CHUNK_BYTES, WINDOW, GATHER = 8 << 20, 1 << 19, 1 << 21
#: Steps of a histogram of counts for each power of two.
STEPS = 8


def words_of(text: str | None) -> list[bytes]:
    """Runs of other than \\x20 and \\x09-\\x0D, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# ---- Texts as arrays of hashes

#: By byte: lower case (A-Z only); white space.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
#: Bytes hashed at once, and the powers of the multiplier and of its inverse up to there.
_SEGMENT = 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, MULTIPLIER), np.full(n + 1, INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes: a polynomial in the multiplier, from sums over the bytes before, then mixed."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + _SEGMENT, side="right")))
        n = int(ends[to - 1]) - low
        up, down = _powers(_SEGMENT) if n <= _SEGMENT else _powers.__wrapped__(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[low : low + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        first = starts[at:to] - low
        out[at:to] = (sums[ends[at:to] - low] - sums[first]) * down[first]
        at = to
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


#: The hash of an end: of a space, which is no word.
END_KEY = hash_words(np.array([32], np.uint8), np.array([0]), np.array([1]))[0]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, null as empty, and where each begins, with the end."""
    texts = pc.fill_null(texts, "")
    at = np.frombuffer(texts.buffers()[1], np.int32 if texts.type in (pa.string(), pa.binary()) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of texts, one after another, and how many words each text has."""
    data, at = _bytes(texts)
    dark = ~_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[at] = True
    starts = np.flatnonzero(dark & (np.append(True, ~dark[:-1])[: len(data)] | border[:-1]))
    ends = np.flatnonzero(dark & (np.append(~dark[1:], True)[: len(data)] | border[1:])) + 1
    return hash_words(_LOWER[data], starts, ends), np.diff(np.searchsorted(starts, at))


@dataclass
class Words:
    """The words of some texts: each one's place among the distinct ones; the hashes of those, and a second that
    tells words of equal hashes apart; how many words each text has."""

    index: np.ndarray
    keys: np.ndarray
    checks: np.ndarray
    lengths: np.ndarray


def distinct(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    parent = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    held = flat.filter(real).dictionary_encode()
    data, at = _bytes(held.dictionary)
    raw = data.tobytes()
    checks = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)), np.uint64, len(at) - 1)
    return Words(held.indices.to_numpy(), hash_words(data, at[:-1], at[1:]), checks, np.bincount(parent[real.to_numpy(zero_copy_only=False)], minlength=len(texts)))


def _chunks(batches: Iterable[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches that hold about CHUNK_BYTES of text each; a longer text is one alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _windows(words: np.ndarray, lengths: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts, each as end, words, end: the tokens' hashes, places in their text and texts; which of them are
    new, those before being seen already and shown again for the grams that reach over the border."""
    sizes = lengths + 2
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    inner = np.ones(total, bool)
    inner[ends - sizes] = inner[ends - 1] = False
    keys = np.full(total, END_KEY)
    keys[inner] = words
    place = np.arange(total) - np.repeat(ends - sizes, sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    for start in range(0, total, WINDOW):
        low = max(0, start - overlap)
        part = slice(low, start + WINDOW)
        yield keys[part], place[part], text[part], np.arange(low, min(start + WINDOW, total)) >= start


def _longer(grams: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Hashes of the grams that end at each token and are one longer than the given ones; the first is none."""
    out = tokens.copy()
    out[1:] += grams[:-1] * MULTIPLIER
    return out


# ---- Sums by key


def _summed(n: np.ndarray, *keys: np.ndarray, by: int = 1, order: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct rows in the order of their first `by` columns, which tell rows apart, and the sums of their n.
    order: one in which equal rows are neighbours and the first column ascends."""
    if order is None:
        order = np.argsort(keys[0], kind="stable") if by == 1 else np.lexsort(keys[:by][::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys[:by]], axis=0)
    at = np.flatnonzero(new)
    return [*(k[at] for k in keys), np.add.reduceat(n[order], at) if len(at) else n[:0]]


class _Gather:
    """Columns of a task, the last one a count, summed and sent to their owners when they are many."""

    def __init__(self, parts: int, by: int):
        self.parts, self.by, self.held, self.size = parts, by, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[Row]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > GATHER:
            yield from self.flush()

    def flush(self) -> Iterator[Row]:
        if self.held:
            *keys, n = (np.concatenate(c) for c in zip(*self.held, strict=True))
            self.held = []
            yield from addressed("count", 0, self.parts, *_summed(n, *keys, by=self.by))
        self.held, self.size = [], 0


def _bits(bucket: int, keys: np.ndarray) -> Row:
    """A bucket's part of the filter of its keys: where it starts, and its bytes."""
    at = keys >> np.uint64(64 - FILTER_BITS)
    low, high = int(at[0]) >> 3, (int(at[-1]) >> 3) + 1
    out = np.zeros(high - low, np.uint8)
    np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64) - low, np.left_shift(1, (at & np.uint64(7)).astype(np.uint8), dtype=np.uint8))
    return bucket, 0, "bits", pack(np.array([low]), out)


def _filter(*tables: DataFrame) -> np.ndarray:
    """One hash, one bit: tells which keys may be in the tables. Its size is fixed."""
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for table in tables:
        for start, part in fetch(table, "bits"):
            out[start[0] : start[0] + len(part)] |= part
    return out


def _maybe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _level(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1)) * STEPS + 1e-9).astype(np.int64)


def _histogram(bucket: int, n: np.ndarray) -> Row:
    return bucket, 0, "histogram", pack(np.bincount(_level(n)))


def _least(tables: Iterable[DataFrame]) -> int:
    """The lowest level of counts such that at most MOST keys have it or a higher one."""
    total = np.zeros(64 * STEPS + 1, np.int64)
    for table in tables:
        for (h,) in fetch(table, "histogram"):
            total[: len(h)] += h
    above = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(above <= MOST)[0])


# ---- Training


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        gather, ends = _Gather(parts, 2), 0
        for chunk in _chunks(batches, 0):
            t = distinct(chunk.column(0))
            ends += chunk.num_rows
            yield from gather.add(t.keys, t.checks, np.bincount(t.index, minlength=len(t.keys)))
        if ends:
            yield from gather.add(np.array([END_KEY]), np.zeros(1, np.uint64), np.array([ends]))
        yield from gather.flush()

    return run


def _own_words(least: int):
    """Words' counts; the distinct hashes with their counts as grams of one token; sums: N, V, ends."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        keys, checks, n = mail.columns("count", 3)
        keys, checks, n = _summed(n, keys, checks, by=2)
        yield bucket, 0, "words", pack(keys, checks, n)
        yield bucket, 0, "sums", pack(np.array([n.sum(), len(n), n[(keys == END_KEY) & (checks == 0)].sum()]))
        yield _histogram(bucket, n)
        keys, n = _summed(n, keys)
        yield bucket, 0, "own", pack(keys, n)
        if (n >= least).any():
            yield _bits(bucket, keys[n >= least])

    return run


def _count_grams(shared, length: int, parts: int):
    """Counts of grams of a length whose first and last length - 1 tokens may both be kept: hash, and hashes of the
    last token and of the tokens between the first and the last, which repeat, and from which those of the context
    and of the suffix follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        bits, gather = shared.value, _Gather(parts, 1)
        for chunk in _chunks(batches, 0):
            for tokens, place, _, new in _windows(*hashed(chunk.column(0)), length):
                shorter, middle = tokens, np.zeros(len(tokens), np.uint64)
                for _ in range(length - 2):
                    shorter, middle = _longer(shorter, tokens), shorter
                may = _maybe(bits, shorter) & (place >= length - 2)
                at = np.flatnonzero(may[1:] & may[:-1] & (place[1:] >= length - 1) & new[1:]) + 1
                yield from gather.add(_longer(shorter, tokens)[at], tokens[at], middle[at - 1], np.ones(len(at), np.int64))
        yield from gather.flush()

    return run


def _own_grams(least: int, discount: float, parts: int):
    """Grams seen often enough; of their contexts the mass that they take away, and what is asked of suffixes."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        *keys, n = mail.columns("count", 4)
        key, last, middle, n = _summed(n, *keys)
        on = n >= least
        if not on.any():
            return
        key, last, middle, n = key[on], last[on], middle[on], n[on]
        context, suffix = (key - last) * INVERSE, last + middle * MULTIPLIER
        yield bucket, 0, "own", pack(key, context, suffix, n)
        yield _bits(bucket, key)
        contexts, place = np.unique(context, return_inverse=True)
        yield from addressed("context", bucket, parts, contexts, np.bincount(place, n - discount))
        yield from addressed("suffix", bucket, parts, np.unique(suffix))

    return run


def _answer(length: int, total: int):
    """Owners of grams of a length tell those that are one longer the context's count and the weight it leaves to
    its suffix, and the suffix's probability. Their own nodes: hash, count, weight, suffix."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        if not mail["own"]:
            return
        if length == 1:
            key, n = mail.columns("own", 2)
            suffix, p = np.zeros(len(key), np.uint64), (n + 1.0) / total
        else:
            key, _, suffix, n, p, _ = mail.columns("own", 6)
        mass, asked = np.zeros(len(key)), [(source, *unpack(data)) for source, data in mail["context"]]
        for _, keys, taken in asked:
            mass[find(key, keys)[0]] += taken
        weight = 1 - mass / n
        for source, keys, _ in asked:
            at = find(key, keys)[0]
            yield source, bucket, "context_is", pack(keys, n[at], weight[at].astype(np.float32))
        for source, data in mail["suffix"]:
            (keys,) = unpack(data)
            yield source, bucket, "suffix_is", pack(keys, p[find(key, keys)[0]].astype(np.float32))
        on = mass > 0
        yield bucket, 0, "node", pack(key[on], n[on], weight[on].astype(np.float32), suffix[on])

    return run


def _weigh(last: bool, discount: float, parts: int):
    """Grams' probabilities and values; of their contexts what they add to the divergence, and the suffix's mass
    that they cover."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        if not mail["own"]:
            return
        key, context, suffix, n = mail.columns("own", 4)
        keys, size, weight = mail.columns("context_is", 3)
        order = np.argsort(keys)
        at = order[find(keys[order], context)[0]]
        size, weight = size[at], weight[at].astype(np.float64)
        keys, below = mail.columns("suffix_is", 2)
        order = np.argsort(keys)
        below = below[order[find(keys[order], suffix)[0]]].astype(np.float64)
        p = (n - discount) / size + weight * below
        value = np.log10(p) - np.log10(weight) - np.log10(below)
        contexts, place = np.unique(context, return_inverse=True)
        yield from addressed("sum", bucket, parts, contexts, np.bincount(place, p * np.log(p / below)).astype(np.float32), np.bincount(place, below).astype(np.float32))
        if last:
            suffix, p = suffix * np.uint64(0), p * 0
        yield bucket, 0, "own", pack(key, context, suffix, n, p.astype(np.float32), value.astype(np.float32))

    return run


def _settle(length: int, least: float, parts: int):
    """Which contexts of a length stay: told to the owners of their grams and, as needed, of their suffixes."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        if not mail["node"]:
            return
        key, n, weight, suffix = mail.columns("node", 4)
        weight = weight.astype(np.float64)
        gain, rest, asked = np.zeros(len(key)), np.zeros(len(key)), [(source, *unpack(data)) for source, data in mail["sum"]]
        for _, keys, g, r in asked:
            at = find(key, keys)[0]
            gain[at] += g
            rest[at] += r
        stays = gain + weight * (1 - rest) * np.log(weight) >= least
        for _, data in mail["needed"]:
            stays[find(key, unpack(data)[0])[0]] = True
        for source, keys, *_ in asked:
            yield source, bucket, "stays", pack(keys[stays[find(key, keys)[0]]])
        if stays.any():
            yield bucket, length, "value", pack(key[stays], np.log10(weight[stays]).astype(np.float32), n[stays])
            yield _histogram(bucket, n[stays])
            yield _bits(bucket, key[stays])
            if length > 1:
                yield from addressed("needed", bucket, parts, np.unique(suffix[stays]))

    return run


def _values(length: int):
    """Values of the grams whose context stays."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        if not mail["own"]:
            return
        key, context, _, n, _, value = mail.columns("own", 6)
        (contexts,) = mail.columns("stays", 1)
        on = find(np.sort(contexts), context)[1]
        if on.any():
            yield bucket, length, "value", pack(key[on], value[on], n[on])
            yield _histogram(bucket, n[on])
            yield _bits(bucket, key[on])

    return run


@dataclass
class Model:
    """total, vocabulary, ends: N, V and how many tokens are ends. words: the written table of words' counts. tree:
    written tables of the values of entries and contexts. length: tokens of the longest gram. parts: buckets."""

    total: int
    vocabulary: int
    ends: int
    words: DataFrame
    tree: list[DataFrame]
    length: int
    parts: int


def train(texts: DataFrame, text_col: str = "text", depth: int = DEPTH, min_count: int = MIN_COUNT, min_divergence: float = MIN_DIVERGENCE, discount: float = DISCOUNT) -> Model:
    """Count all texts and build the tree."""
    spark = texts.sparkSession
    picked = texts.select(col(text_col).alias("text"))
    parts = buckets(picked)
    least = max(2, min_count)
    words = step(_own_words(least), "words", send(picked, _count_words(parts)), parts=parts)
    total, vocabulary, ends = np.sum([s for (s,) in fetch(words, "sums")] or [[0, 0, 0]], axis=0).tolist()
    own, bits, levels = kind_of(words, "own"), _filter(words), []
    for length in range(2, depth + 2):
        shared = spark.sparkContext.broadcast(bits)
        grams = step(_own_grams(least, discount, parts), "grams", send(picked, _count_grams(shared, length, parts)), parts=parts)
        shared.destroy()
        if kind_of(grams, "own").isEmpty():
            release(grams)
            break
        bits = _filter(grams)
        told = step(_answer(length - 1, total + vocabulary + 1), "told", own, kind_of(grams, "context", "suffix"), parts=parts)
        if length == 2:
            drop(words, "own")
        weighed = step(_weigh(length > depth, discount, parts), "weighed", kind_of(grams, "own"), kind_of(told, "context_is", "suffix_is"), parts=parts)
        drop(told, "context_is", "suffix_is")
        release(grams)
        levels.append((length, told, weighed))
        own = kind_of(weighed, "own")
    tree: list[DataFrame] = []
    needed: list[DataFrame] = []
    for length, told, weighed in reversed(levels):
        settled = step(_settle(length - 1, min_divergence, parts), "settled", kind_of(told, "node"), kind_of(weighed, "sum"), *needed, parts=parts)
        tree += [settled, step(_values(length), "values", kind_of(weighed, "own"), kind_of(settled, "stays"), parts=parts)]
        needed = [kind_of(settled, "needed")]
        release(told, weighed)
    for settled in tree[::2]:
        drop(settled, "stays", "needed")
    return Model(total, vocabulary, ends, words, tree, len(levels) and len(levels) + 1, parts)


# ---- Scoring


@dataclass
class _Known:
    """What every worker holds: the frequent words and grams, and the filter of all others."""

    words: tuple[np.ndarray, np.ndarray, np.ndarray]
    grams: tuple[np.ndarray, np.ndarray]
    bits: np.ndarray
    ends: int
    unit: float
    length: int
    parts: int


def _often(least: int, at: int):
    """Of packed columns those rows whose last column, a count, is of a level or a higher one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        for batch in batches:
            for data in batch.column(at).to_pylist():
                columns = unpack(data)
                on = _level(columns[-1]) >= least
                if on.any():
                    yield 0, 0, "often", pack(*(c[on] for c in columns))

    return run


def _frequent(tables: list[DataFrame], kind: str, columns: int) -> list[np.ndarray]:
    least = _least(tables)
    held = [x for t in tables for x in fetch(send(kind_of(t, kind), _often(least, 3)), "often")]
    return [np.concatenate(c) for c in zip(*held, strict=True)] if held else [np.zeros(0, np.uint64)] * columns


def _ids(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ask(shared):
    """For each chunk of texts a row of what is known here, and rows that ask owners for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        known: _Known = shared.value
        task, number = TaskContext.get().partitionId(), 0
        for chunk in _chunks(batches, 1):
            block, home = task << 20 | number, (task + number) % known.parts
            number += 1
            rows = chunk.num_rows
            t = distinct(chunk.column(1))
            text = np.repeat(np.arange(rows), t.lengths)
            # Words: those that are broadcast count here. Counts by text and word, each pair once.
            pair, n = np.unique(text * len(t.keys) + t.index, return_counts=True)
            text, index = pair // max(1, len(t.keys)), pair % max(1, len(t.keys))
            at, hit = find(known.words[0], t.keys)
            hit &= known.words[1][at] == t.checks if len(known.words[0]) else False
            logs = np.zeros(len(t.keys))
            logs[hit] = np.log10(known.words[2][at[hit]] + 1.0) - known.unit
            here = hit[index]
            base = np.bincount(text, n * logs[index], rows) + (np.log10(known.ends + 1.0) - known.unit)
            sure = np.bincount(text, n * here, rows).astype(np.int64) + (known.ends > 0)
            text, index, n = text[~here], index[~here], n[~here]
            order = np.argsort(t.keys[index], kind="stable")
            index = index[order]
            yield from addressed("word", block << 20 | home, known.parts, t.keys[index], t.checks[index], text[order].astype(np.uint32), n[order].astype(np.uint32))
            gain = np.zeros(rows)
            for tokens, place, text, new in _windows(t.keys[t.index], t.lengths, known.length):
                grams, asked = tokens, [(tokens[:0], text[:0])]
                for length in range(1, known.length + 1):
                    grams = _longer(grams, tokens) if length > 1 else tokens
                    # A text's last end is no context.
                    on = np.flatnonzero(new & (place >= length - 1) & ((length > 1) | (tokens != END_KEY) | (place == 0)))
                    on = on[_maybe(known.bits, grams[on])]
                    at, hit = find(known.grams[0], grams[on])
                    if hit.any():
                        gain += np.bincount(text[on[hit]], known.grams[1][at[hit]], rows)
                    asked.append((grams[on[~hit]], text[on[~hit]]))
                keys, text = (np.concatenate(c) for c in zip(*asked, strict=True))
                # Texts ascend in the grams of a length, so equal pairs are neighbours in a stable order of the grams.
                keys, text, n = _summed(np.ones(len(keys), np.int64), keys, text, by=2, order=np.argsort(keys, kind="stable"))
                yield from addressed("gram", block << 20 | home, known.parts, keys, text.astype(np.uint32), n.astype(np.uint32))
            names = ["id", "n_tokens", "known", "base", "gain"]
            yield home, block << 20 | home, "texts", _ids(pa.RecordBatch.from_arrays([chunk.column(0), *map(pa.array, (t.lengths.astype(np.int64) + 1, sure, base, gain))], names=names))

    return run


def _look_up(keys: np.ndarray, checks: np.ndarray, asked: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words by both hashes, the first of which ascends; and whether they are there."""
    at, hit = find(keys, asked)
    for i in np.flatnonzero(hit)[checks[at[hit]] != check[hit]]:
        places = np.arange(at[i], np.searchsorted(keys, asked[i], side="right"))
        same = places[checks[places] == check[i]]
        at[i], hit[i] = same[0] if len(same) else 0, len(same) > 0
    return at, hit


def _reply(unit: float):
    """Owners' sums by text for what a chunk asked."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        for source, data in mail["texts"]:
            yield bucket, source, "texts", data
        if mail["word"]:
            keys, checks, n = mail.columns("words", 3)
            for source, data in mail["word"]:
                asked, check, text, many = unpack(data)
                at, hit = _look_up(keys, checks, asked, check)
                count = np.zeros(len(asked))
                count[hit] = n[at[hit]]
                places, place = np.unique(text, return_inverse=True)
                yield source & (1 << 20) - 1, source, "counted", pack(places, np.bincount(place, many * (np.log10(count + 1.0) - unit)), np.bincount(place, many * (count > 0)).astype(np.uint32))
        if mail["gram"]:
            keys, value, _ = mail.columns("value", 3)
            keys, value = _summed(value.astype(np.float64), keys)
            for source, data in mail["gram"]:
                asked, text, many = unpack(data)
                at, hit = find(keys, asked)
                if hit.any():
                    places, place = np.unique(text[hit], return_inverse=True)
                    yield source & (1 << 20) - 1, source, "gained", pack(places, np.bincount(place, many[hit] * value[at[hit]]))

    return run


def _total(names: list[str]):
    """Chunks' texts with the sums of all owners."""

    def finish(mail: Mail) -> Iterator[pa.RecordBatch]:
        more: dict[int, list] = {}
        for kind in ("counted", "gained"):
            for source, data in mail[kind]:
                more.setdefault(source, []).append((kind, data))
        for source, data in mail["texts"]:
            batch = pa.ipc.open_stream(data).read_next_batch()
            known, base, gain = (batch.column(k).to_numpy(zero_copy_only=False).copy() for k in (2, 3, 4))
            for kind, held in more.get(source, ()):
                if kind == "counted":
                    at, terms, n = unpack(held)
                    base[at] += terms
                    known[at] += n
                else:
                    at, terms = unpack(held)
                    gain[at] += terms
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(known), pa.array(base), pa.array(base + gain)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mails: list[Mail] = []
        for _ in owners(lambda bucket, mail: mails.append(mail) or ())(batches):
            pass
        for mail in mails:
            yield from finish(mail)

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_tokens, n_known, base_score, score."""
    spark = docs.sparkSession
    unit = float(np.log10(model.total + model.vocabulary + 1.0))
    keys, checks, n = _frequent([model.words], "words", 3)
    order = np.lexsort((checks, keys))
    # Of words with one hash only the first is looked up here; the others are asked for.
    order = order[np.append(True, keys[order][1:] != keys[order][:-1])] if len(order) else order
    grams, value, _ = _frequent(model.tree, "value", 3)
    # A gram's entry and context have one count: both are here or neither.
    grams, value = _summed(value.astype(np.float64), grams)
    known = _Known((keys[order], checks[order], n[order]), (grams, value), _filter(*model.tree), model.ends, unit, model.length, model.parts)
    shared = spark.sparkContext.broadcast(known)
    picked = stable(docs.select(col(id_col).alias("id"), col(text_col).alias("text")))
    kind = picked.schema["id"].dataType.simpleString()
    asks = send(picked, _ask(shared))
    replies = send(deal(asks, kind_of(model.words, "words"), *(kind_of(t, "value") for t in model.tree), parts=model.parts), owners(_reply(unit)))
    names = ["id", "n_tokens", "n_known", "base_score", "score"]
    out = map_arrow(deal(replies, parts=model.parts), _total(names), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", mod: int = 7, rest: int = 2) -> Column:
    return F.crc32(F.encode(id_text(id_col), "UTF-8")) % mod == rest


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    """Query: all whole documents scored by a tree learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(~held_out()))
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
