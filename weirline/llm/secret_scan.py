"""Secret scans by a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: an AND/OR tree that every
match must satisfy, in the spirit of trigram code search. An index segment (a batch of texts) is cut into all its
trigrams, once, and keeps the postings of those that the rules ask for; a rule's query intersects and unites postings, and the
candidates are verified with the rule itself on their whole text. A rule without mandatory trigrams scans
every text. Segments are built, queried and dropped by the task that reads the texts, so nothing is
shuffled and no posting list is longer than a segment; the postings can also be written for other rule
sets (`index_postings`).

Defined results: null text counts as empty, without spans; offsets are code points, end exclusive;
repeated rows give repeated result rows; a null id is passed on; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from re import _constants as sre  # noqa: PLC2701
from re import _parser as sre_parser  # noqa: PLC2701

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._common import col, map_arrow

_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: A literal set larger than this is cut into its trigrams.
MOST_STRINGS = 48

# ---- Boolean trigram queries: None (anything), ("and", items), ("or", items), or a trigram.


def _all(items: list) -> object:
    flat: list = []
    for x in items:
        if x is not None:
            flat += x[1] if isinstance(x, tuple) and x[0] == "and" else [x]
    flat = list(dict.fromkeys(flat))
    return None if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _any(items: list) -> object:
    if not items or any(x is None for x in items):
        return None
    flat = list(dict.fromkeys(items))
    return flat[0] if len(flat) == 1 else ("or", tuple(flat))


def _of_strings(strings: set[str]) -> object:
    """What a text holds that holds one of the strings."""
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _chars(items: list) -> set[str] | None:
    """The characters of a class, folded, if they are few."""
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(chr(arg).translate(_FOLD))
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).translate(_FOLD) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _strings(tree) -> tuple[set[str] | None, object]:
    """Of a parsed pattern: all folded strings it matches, if they are few, and its trigram query."""
    held: set[str] = {""}
    queries: list = []

    def cut() -> None:
        nonlocal held
        queries.append(_of_strings(held))
        held = {""}

    whole = True
    for op, arg in tree:
        strings: set[str] | None = None
        query = None
        if op is sre.LITERAL:
            strings = {chr(arg).translate(_FOLD)}
        elif op is sre.IN:
            strings = _chars(arg)
        elif op is sre.SUBPATTERN:
            strings, query = _strings(arg[3])
        elif op is sre.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            query = _any([q for _, q in parts])
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, sub = arg
            inner, inner_query = _strings(sub)
            if (low, high) == (0, 1) and inner is not None:
                strings = inner | {""}
            elif low == high == 1:
                strings, query = inner, inner_query
            elif low >= 1:
                query = inner_query
                if inner is not None and low <= 4:
                    first = {""}
                    for _ in range(low):
                        first = {a + b for a in first for b in inner}
                    if len(first) <= MOST_STRINGS:
                        query = _all([query, _of_strings(first)])
        elif op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
            continue
        if strings is not None and len(held) * len(strings) <= MOST_STRINGS:
            held = {a + b for a in held for b in strings}
            continue
        whole = False
        cut()
        queries.append(query)
        if strings is not None:
            held = set(strings) if len(strings) <= MOST_STRINGS else {""}
    if whole:
        return held, _of_strings(held)
    cut()
    return None, _all(queries)


def trigram_query(pattern: str, flags: int = 0):
    """The Boolean query over lower-case trigrams that every text with a match satisfies; None: any text."""
    return _strings(sre_parser.parse(pattern, flags))[1]


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(x) for x in query[1]))


def evaluate(query, postings: dict, everything: set[int]) -> set[int]:
    """The texts that satisfy a query."""
    if query is None:
        return everything
    if isinstance(query, str):
        return set(map(int, postings.get(query, ())))
    parts = sorted((evaluate(x, postings, everything) for x in query[1]), key=len)
    return set.intersection(*parts) if query[0] == "and" else set.union(*parts)


@dataclass(frozen=True)
class Rule:
    """kind; pattern; keep: which matches count; guard: characters that may not stand around a match."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    least: int = 0
    group: int = 0
    query: object = field(default=None, compare=False)

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)


#: The base rules of the contract (fixed values), in the order that ranks equal starts.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Rules that the index adds: well-known public token forms (fixed values).
MORE = (
    # To the END line; where it is missing, over headers and base64 lines, also those whose line ends are escaped or spaces.
    Rule(
        "pem",
        r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"
        r"(?:(?:(?!-----BEGIN )[^\0])*?-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"
        r"|(?:\r?\n[\x20\t]*(?:[A-Za-z0-9-]+:[^\r\n]*|[A-Za-z0-9+/=]*)[\x20\t]*(?=[\r\n]|\Z)|(?:\\r)?\\n[A-Za-z0-9+/=]*|[\x20\t]+[A-Za-z0-9+/=]{16,})*)",
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + MORE

Span = tuple[str, int, int]

#: Bytes of a segment that are cut into trigrams at once: their numbers take thirty times as many.
PART = 1 << 18
#: By byte: A-Z lower-cased.
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


@lru_cache(maxsize=4)
def _numbers(wanted: tuple[str, ...]) -> np.ndarray:
    """By three bytes as a number: the place of the wanted trigram that they are, from 1; 0 for all others."""
    out = np.zeros(1 << 24, np.uint16)
    for place, g in enumerate(wanted, 1):
        raw = g.encode()
        if len(raw) != 3:
            raise ValueError(f"{g!r} is no trigram of ASCII characters")
        out[raw[0] << 16 | raw[1] << 8 | raw[2]] = place
    return out


def build_index(texts: list[str], wanted: tuple[str, ...]) -> dict[str, np.ndarray]:
    """A segment's postings: all texts are cut into their trigrams, and of each wanted one the ascending places
    of the texts that hold it are kept."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    # A zero byte between texts: no wanted trigram reaches over it.
    data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    numbers = _numbers(wanted)
    for start in range(0, len(data), PART):
        part = _LOW[data[start : start + PART + 2]].astype(np.uint32)
        found = numbers[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
        at = np.flatnonzero(found)
        held.append((found[at].astype(np.int64), np.searchsorted(ends, at + start, side="right")))
    number, text = (np.concatenate(c) for c in zip(*held, strict=True)) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    both = np.unique(number * (len(texts) + 1) + text)
    number, text = both // (len(texts) + 1), both % (len(texts) + 1)
    cuts = np.searchsorted(number, np.arange(1, len(wanted) + 2))
    return {g: text[cuts[k] : cuts[k + 1]] for k, g in enumerate(wanted) if cuts[k] < cuts[k + 1]}


def scan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[Span]]:
    """Spans (kind, start, end) of each text of one index segment, by start, then by the rules' order."""
    queries = [trigram_query(r.pattern, r.flags) for r in rules]
    postings = build_index(texts, tuple(sorted(set().union(*map(trigrams_of, queries)))))
    everything = set(range(len(texts)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for rank, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        pattern, least, group = rule.compiled(), rule.least, rule.group
        if rule.pattern == r"[0-9a-f]+" and least > 1:
            # A run of the class is one match; only runs long enough are looked for.
            pattern = re.compile(r"[0-9a-f]{%d,}" % least, rule.flags)
        for i in evaluate(query, postings, everything):
            found[i] += [(m.start(), rank, m.end()) for m in pattern.finditer(texts[i]) if m.end(group) - m.start(group) >= least]
    return [[(rules[rank].kind, start, end) for start, rank, end in sorted(x)] for x in found]


def index_postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", segment: int = 10_000) -> DataFrame:
    """The segments' postings for the trigrams of a rule set: segment, trigram, texts (places in the segment)."""
    wanted = tuple(sorted(set().union(*(trigrams_of(trigram_query(r.pattern, r.flags)) for r in rules))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, segment):
                index = build_index([t or "" for t in batch.column(0).slice(at, segment).to_pylist()], wanted)
                rows = [(g, places.tolist()) for g, places in index.items()]
                yield pa.RecordBatch.from_arrays([pa.array([task << 32 | number] * len(rows), pa.int64()), pa.array([g for g, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.list_(pa.int32()))], names=["segment", "trigram", "texts"])
                number += 1

    return map_arrow(docs.select(col(text_col).alias("text")), run, "segment long, trigram string, texts array<int>")


def _per_segment(df: DataFrame, text_at: int, finish: Callable[[pa.RecordBatch, list[str], list[list[Span]]], list[pa.Array]], schema: str, rules: tuple[Rule, ...], segment: int = 2_000) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, segment):
                part = batch.slice(at, segment)
                texts = [t or "" for t in part.column(text_at).to_pylist()]
                yield pa.RecordBatch.from_arrays(finish(part, texts, scan(texts, rules)), names=names)

    return map_arrow(df, run, schema)


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: id_col, spans (array of kind, start, end)."""
    picked = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def finish(batch, texts, spans):
        return [batch.column(0), pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], of)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(finish(part, texts, scan(texts, rules)), names=["id", "spans"])

    return map_arrow(picked, run, f"id {kind}, spans array<struct<kind: string, start: int, end: int>>").withColumnRenamed("id", id_col)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are merged under the first."""
    out, at, end_of_last = [], 0, -1
    merged: list[list] = []
    for kind, start, end in spans:
        if merged and start < end_of_last:
            merged[-1][2] = end_of_last = max(end_of_last, end)
        else:
            merged.append([kind, start, end])
            end_of_last = end
    for kind, start, end in merged:
        out += [text[at:start], f"[REDACTED:{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span of their texts replaced; rows and other columns stay as they are."""
    from pyspark.sql.pandas.types import to_arrow_schema

    at = docs.columns.index(text_col)
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                texts = part.column(at).to_pylist()
                spans = scan([t or "" for t in texts], rules)
                new = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)], schema.field(at).type)
                yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(part.columns)], names=part.schema.names)

    return map_arrow(docs, run, docs.schema)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Query: secrets in every whole text of documents."""
    base = {r.kind for r in BASE}

    def finish(batch, texts, spans):
        only = [[x for x in s if x[0] in base] for s in spans]
        count = lambda kind: pa.array([sum(x[0] == kind for x in s) for s in only], pa.int64())
        digest = [hashlib.sha256(join_spans(s).encode()).hexdigest() for s in only]
        return [batch.column(0), count("assign"), count("access"), count("hex"), pa.array(digest, pa.string()), pa.array(map(join_spans, spans), pa.string())]

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _per_segment(docs, 1, finish, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", RULES)
