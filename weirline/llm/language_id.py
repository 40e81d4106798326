"""Language identification: words first, then ever shorter character n-grams.

A text's words (runs of letters, lower-cased) are scored by their log frequency in each language. A word
that the model doesn't know is scored by its character n-grams instead: the longest known n-gram at each
place, backing off to shorter ones, averaged to the weight of one word. The prediction is the language
with the highest sum; the score is its posterior, with the sum over words scaled to at most EVIDENCE words.

The model is counted over all labelled training texts. It keeps the words and n-grams whose share of a
language's words (n-grams) is at least MIN_SHARE, so it has at most 1/MIN_SHARE of each for a language,
whatever the data: that bounds what is broadcast.

Defined results: `und`, score 0, if the text is null or empty, has no letter, or nothing was learned;
repeated rows give repeated result rows; ids may be null; labels that are null don't teach. Ties go to
the language that sorts first. Input columns named lang_pred or score are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, id_text, map_arrow, materialize, release

#: Least share of a language's words, or n-grams of one length, that an entry of the model has.
MIN_SHARE = 5e-6
#: Longest n-gram of the back-off.
LONGEST = 4
#: Words whose evidence counts in full for the score.
EVIDENCE = 50
#: Least score at which a text's language takes the place of its label in the pipeline.
SURE = 0.99
#: Longest run of letters that is counted as a word. Of longer ones, as in scripts without spaces, the n-grams are
#: counted, all of them, in pieces of so many places, and by these they are scored.
WORD_CHARS = 64
UNKNOWN = "und"
#: In place of a language, for a text with letters where no language was learned.
LETTERS = "letters"
_WORD = re.compile(r"[^\W\d_]+")
#: Distinct words that a task counts before it passes them on.
COUNT_AT_MOST = 200_000
#: Characters of the texts whose words are told apart together; only time and memory depend on it.
PART_CHARS = 2_000_000
#: Most entries of a table that finds a level's n-grams directly; a longer one is searched.
DIRECT = 1 << 22


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def pieces_of(word: str) -> list[tuple[str, int]]:
    """A long run in pieces (text, places): the n-grams that begin at a piece's first `places` places are the run's, each once."""
    marked = f" {word} "
    return [(marked[i : i + WORD_CHARS + LONGEST - 1], min(WORD_CHARS, len(marked) - i)) for i in range(0, len(marked), WORD_CHARS)]


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0, no part of a word; 1, a number that words may hold (such as a fraction); 2, a letter."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    kinds = np.zeros(len(every), np.uint8)
    for run in _WORD.finditer(every):
        kinds[run.start() : run.end()] = [1 + c.isalpha() for c in run[0]]
    return kinds


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _strings(points: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """Strings that lie one after the other, by their ends."""
    data = points.tobytes().decode("utf-32-le").encode()
    if len(data) > len(points):
        widths = np.ones(len(points) + 1, np.uint8)
        widths[0] = 0
        for least in (0x80, 0x800, 0x10000):
            widths[1:] += points >= least
        ends = np.cumsum(widths, dtype=np.int64)[ends]
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))


def _listed(strings: pa.StringArray) -> list[str]:
    # Without nulls; by numpy this takes a ninth of to_pylist's time.
    return strings.to_numpy(zero_copy_only=False).tolist()


def split_words(texts: list[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The words of all texts, those of `words_of` in their order; how many each text has; whether it has a letter."""
    low = [t.lower() for t in texts]
    points = _points("\n" + "".join(f"{t}\n" for t in low))
    kinds = _kinds()[points]
    inside = kinds > 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([1, *(len(t) + 1 for t in low)])
    lettered = np.logical_or.reduceat(kinds == 2, begins[:-1]) if texts else np.zeros(0, bool)
    return _strings(points[inside], np.cumsum(ends - starts)), np.diff(np.searchsorted(starts, begins)), lettered


def _parts(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts, null as empty, a part at a time whose characters are about PART_CHARS at most, or one text."""
    part, chars = [], 0
    for t in texts:
        t = t or ""
        if part and chars + len(t) > PART_CHARS:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    if part:
        yield part


def _add_up(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Tables of counts `n`, those of equal other columns added up; passed on when more than COUNT_AT_MOST are left."""
    held: list[pa.Table] = []
    rows = 0

    def added() -> pa.Table:
        keys = held[0].column_names[:-1]
        return pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")]).select([*keys, "n_sum"]).rename_columns([*keys, "n"])

    for table in tables:
        if not table.num_rows:
            continue
        held.append(table)
        rows += table.num_rows
        if rows > 2 * COUNT_AT_MOST:
            held = [added()]
            rows = held[0].num_rows
            if rows > COUNT_AT_MOST:
                yield from held.pop().to_batches()
                rows = 0
    if held:
        yield from added().to_batches()


def _words_of_language(texts: list[str], lang: str) -> Iterator[pa.Table]:
    for part in _parts(texts):
        found = split_words(part)[0].value_counts()
        words, n = found.field(0), found.field(1)
        long = pc.greater(pc.utf8_length(words), WORD_CHARS)
        pieces = [(*p, k) for w, k in zip(words.filter(long).to_pylist(), n.filter(long).to_pylist(), strict=True) for p in pieces_of(w)]
        short = pc.invert(long)
        words, n = words.filter(short), n.filter(short)
        for w, places, k in ((words, pa.repeat(pa.scalar(0, pa.int32()), len(words)), n), [pa.array([p[i] for p in pieces], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))]):
            yield pa.table({"lang": pa.repeat(lang, len(w)), "word": w, "places": places, "n": k})


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tables() -> Iterator[pa.Table]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                texts: dict[str, list[str | None]] = {}
                for text, lang in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text.as_py())
                for lang, of_lang in texts.items():
                    yield from _words_of_language(of_lang, lang)

    yield from _add_up(tables())


def _grams_of_rows(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """The n-grams of counted words or pieces: characters by their rank among the batch's, so that a number holds an n-gram."""
    words = [w if places else f" {w} " for w, places in zip(_listed(batch.column(1)), batch.column(2).to_numpy().tolist(), strict=True)]
    points = _points("".join(f"{w}\n" for w in words))
    seen = np.zeros(sys.maxunicode + 1, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    kinds = len(alphabet)
    if kinds**LONGEST >= 1 << 63:  # more than 55,000 different characters; a word or piece alone has few
        half = batch.num_rows // 2
        yield from _grams_of_rows(batch.slice(0, half))
        yield from _grams_of_rows(batch.slice(half))
        return
    rank = np.cumsum(seen, dtype=np.int32) - 1
    ids = rank[points].astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(lengths + 1) - lengths - 1
    first = batch.column(2).to_numpy()
    first = np.where(first == 0, lengths, np.minimum(first, lengths))
    owner = np.repeat(np.arange(len(words)), first)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(first) - first, first)
    left = lengths[owner] - at
    at += begins[owner]
    langs = batch.column(0).dictionary_encode()
    lang, n = langs.indices.to_numpy(), batch.column(3).to_numpy()
    key = ids[at]
    for size in range(1, LONGEST + 1):
        if size > 1:
            fits = left >= size
            owner, at, left, key = owner[fits], at[fits], left[fits], key[fits]
            key = key * kinds + ids[at + size - 1]
        found = pa.table({"lang": lang[owner], "key": key, "n": n[owner]}).group_by(["lang", "key"], use_threads=False).aggregate([("n", "sum")])
        keys = found["key"].to_numpy()
        letters = np.stack([alphabet[keys // kinds ** (size - 1 - k) % kinds] for k in range(size)], axis=1)
        grams = _strings(letters.ravel(), np.arange(1, len(keys) + 1) * size)
        yield pa.table({"lang": langs.dictionary.take(found["lang"].combine_chunks()), "size": pa.repeat(pa.scalar(size, pa.int32()), len(keys)), "gram": grams, "n": found["n_sum"]})


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _add_up(t for batch in batches if batch.num_rows for t in _grams_of_rows(batch))


class _Grams:
    """The model's n-grams as a trie: nodes of a level are numbered from 1 (0: none), a child is found by parent and character."""

    def __init__(self, grams: dict[str, int]):
        sized = [[g for g in grams if len(g) == size] for size in range(1, LONGEST + 1)]
        points = [_points("".join(found)).reshape(-1, size) for size, found in enumerate(sized, 1)]
        alphabet = np.unique(np.concatenate([p.ravel() for p in points]))
        self.ids = np.zeros(sys.maxunicode + 1, np.int32)
        self.ids[alphabet] = np.arange(1, len(alphabet) + 1)
        self.base = len(alphabet) + 1
        self.levels: list[tuple[np.ndarray, bool, np.ndarray]] = []
        at, nodes = [np.zeros(len(p), np.int64) for p in points], 1
        for level in range(LONGEST):
            at = [node * self.base + self.ids[p[:, level]] if level < p.shape[1] else node[:0] for node, p in zip(at, points, strict=True)]
            keys = np.unique(np.concatenate(at))
            at = [np.searchsorted(keys, k) + 1 for k in at]
            rows = np.full(len(keys) + 1, -1)
            rows[at[level]] = [grams[g] for g in sized[level]]
            direct = nodes * self.base <= DIRECT or not len(keys)
            if direct:
                # One 0 at least: without keys all are asked for there.
                table = np.zeros(nodes * self.base if len(keys) else 1, np.int32)
                table[keys] = np.arange(1, len(keys) + 1)
                keys = table
            self.levels.append((keys, direct, rows))
            nodes = len(rows)

    def child(self, level: int, node: np.ndarray | int, ids: np.ndarray) -> np.ndarray:
        keys, direct, _ = self.levels[level]
        asked = node * self.base + ids
        if direct:
            return keys[asked] if len(keys) > 1 else np.zeros(len(asked), np.int64)
        k = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[k] == asked, k + 1, 0)

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each place of words the row of its longest known n-gram there, and the word; places without one are left out."""
        # The line's end is in no n-gram, so none goes from a word into the next.
        points = _points("".join(f" {w} \n" for w in words) + "\n" * LONGEST)
        ids, end = self.ids[points].astype(np.int64), points == ord("\n")
        at = np.flatnonzero(~end & (points != ord(" ")))
        # Of one character the n-gram is the place's own; longer ones begin with the character before it.
        rows = self.levels[0][2][self.child(0, 0, ids[at])]
        node = self.child(0, 0, ids[at - 1])
        for level in range(1, LONGEST):
            node = self.child(level, node.astype(np.int64), ids[at - 1 + level])
            found = self.levels[level][2][node]
            rows = np.where(found >= 0, found, rows)
        known = rows >= 0
        return rows[known], np.cumsum(end)[at[known]]


class Model:
    """Log frequencies: rows of `table` by word or n-gram, a column for each language."""

    def __init__(self, langs: list[str], words: dict[tuple[str, str], float], grams: dict[tuple[str, str], float], floors: dict[tuple[str, int], float]):
        self.langs = langs
        at = {lang: k for k, lang in enumerate(langs)}
        floor = np.array([[floors.get((lang, size), math.log(MIN_SHARE / 2)) for lang in langs] for size in range(LONGEST + 1)]).reshape(LONGEST + 1, len(langs))
        self.words = {w: i for i, w in enumerate(dict.fromkeys(w for _, w in words))}
        self.word_table = np.repeat(floor[:1], len(self.words), axis=0)
        for (lang, w), p in words.items():
            self.word_table[self.words[w], at[lang]] = p
        self.grams = {g: i for i, g in enumerate(dict.fromkeys(g for _, g in grams))}
        self.gram_table = floor[np.array([len(g) for g in self.grams], dtype=np.int64)]
        for (lang, g), p in grams.items():
            self.gram_table[self.grams[g], at[lang]] = p
        self.trie: _Grams | None = None

    def _predict_part(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        words, sizes, lettered = split_words(texts)
        kinds = words.dictionary_encode()
        kind, distinct = kinds.indices.to_numpy(), _listed(kinds.dictionary)
        row = np.fromiter(map(self.words.get, distinct, repeat(-1)), np.int64, len(distinct))
        known, unseen = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        # An unseen word is the mean of its places.
        self.trie = self.trie or _Grams(self.grams)
        places, owner = self.trie.rows_of([distinct[k] for k in unseen.tolist()])
        many = np.maximum(np.bincount(owner, minlength=len(unseen)), 1)
        text = np.repeat(np.arange(len(texts)), sizes)
        total, value = np.empty((len(texts), len(self.langs))), np.empty(len(distinct))
        for k in range(len(self.langs)):
            value[known] = self.word_table[row[known], k]
            value[unseen] = np.bincount(owner, self.gram_table[places, k], len(unseen)) / many
            total[:, k] = np.bincount(text, value[kind], len(texts))
        scaled = total * np.minimum(1.0, EVIDENCE / np.maximum(sizes, 1))[:, None]
        best = scaled.argmax(axis=1)
        score = 1 / np.exp(np.clip(scaled - scaled.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
        # Runs may hold numbers that are no decimal digits (such as fractions): one letter at least is asked for.
        return [self.langs[b] if has else UNKNOWN for b, has in zip(best.tolist(), lettered.tolist(), strict=True)], np.where(lettered, score, 0.0)

    def predict_all(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and the score of each text; words of a part of the texts are told apart by Arrow and looked up once."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        done = [self._predict_part(part) for part in _parts(texts)]
        return [x for langs, _ in done for x in langs], np.concatenate([np.zeros(0), *(scores for _, scores in done)])

    def predict(self, text: str | None) -> tuple[str, float]:
        langs, scores = self.predict_all([text])
        return langs[0], float(scores[0])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE) -> Model:
    """Count all labelled texts (rows with a null label teach nothing)."""
    picked = labelled.select(col(text_col).alias("text"), col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL")
    counted = map_arrow(picked, _count_words, "lang string, word string, places int, n long").groupBy("lang", "word", "places").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "words")
    # A language may have no words but long runs: it is learned from their n-grams.
    sums = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum(F.when(F.col("places") == 0, F.col("n")).otherwise(F.lit(0))).alias("n")).collect()}
    if not sums:
        return Model([], {}, {}, {})
    langs = sorted(sums)
    # A share of its language: at most 1/min_share rows a language pass.
    least = F.create_map(*[F.lit(x) for lang, n in sums.items() for x in (lang, n * min_share)])
    kept = counted.filter((F.col("places") == 0) & (F.col("n") >= F.element_at(least, F.col("lang")))).collect()
    words = {(r.lang, r.word): math.log(r.n / sums[r.lang]) for r in kept}
    # The words are few and small, their n-grams many: they are dealt to all tasks again.
    spread = counted.select("lang", "word", "places", "n").repartition(int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")
    grams = materialize(map_arrow(spread, _count_grams, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "grams")
    gram_sums = {(r.lang, r.size): r.n for r in grams.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    bound = F.create_map(*[F.lit(x) for (lang, size), n in gram_sums.items() for x in (f"{size}{lang}", n * min_share)])
    kept = grams.filter(F.col("n") >= F.element_at(bound, F.concat(F.col("size").cast("string"), "lang"))).collect()
    logs = {(r.lang, r.gram): math.log(r.n / gram_sums[r.lang, r.size]) for r in kept}
    release(counted, grams)
    floors = {(lang, size): math.log(min_share / 2) for lang in langs for size in range(LONGEST + 1)}
    return Model(langs, words, logs, floors)


def has_letter(text: str | None) -> bool:
    # Runs may hold numbers that are no decimal digits (such as fractions): one letter at least is asked for.
    return bool(text) and any(c.isalpha() for w in _WORD.finditer(text) for c in w[0])


def predict(docs: DataFrame, model: Model, text_col: str = "text", lettered: bool = False) -> DataFrame:
    """docs with lang_pred and score, in place of columns of these names; lettered: a text with letters is told from one
    without where nothing was learned."""
    from pyspark.sql import types as T

    docs = docs.drop("lang_pred", "score")

    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                texts = part.column(at).to_pylist()
                if lettered and not model.langs:
                    langs, scores = [LETTERS if has_letter(t) else UNKNOWN for t in texts], np.zeros(len(texts))
                else:
                    langs, scores = model.predict_all(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(docs, run, schema)


def held_out(id_col: str = "doc_id", mod: int = 5, rest: int = 0):
    return F.crc32(F.encode(id_text(id_col), "UTF-8")) % mod == rest


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Query: the language of every whole text of documents, learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(~held_out()))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs less those without a language: null, empty or without a letter. Those that stay get the language that they are
    identified as, in place of their label, where the score is SURE at least or there is no label.

    Whether a text has a language is told by its letters, so no document goes for want of labels, and where none was learned
    from labels stay as they are.
    """
    names, at = docs.columns, docs.columns.index(lang_col)
    model = train(docs, text_col, lang_col)
    tagged = predict(docs.select(F.struct("*").alias("rec"), col(text_col).alias("text")), model, lettered=True)
    kept = tagged.filter(F.col("lang_pred") != UNKNOWN)
    label, found = F.col("rec")[lang_col], F.col("lang_pred").cast(docs.schema[lang_col].dataType)
    lang = F.when((F.col("lang_pred") != LETTERS) & (label.isNull() | (F.col("score") >= SURE)), found).otherwise(label)
    return kept.select(*[lang.alias(n) if k == at else F.col("rec")[n].alias(n) for k, n in enumerate(names)])
