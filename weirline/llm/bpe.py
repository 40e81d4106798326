"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut where every match of the pre-token pattern starts anyway: before a space that has a
non-space on either side. A block of texts has its distinct words, and of each text the words' numbers by
position. The words go to the tasks that own their hashes, a block's words for an owner as one compressed
value; an owner encodes each distinct word once, whatever number of blocks sent it, and sends each block the ids of
its words in the order in which they came. The block's task puts every text together by position and decodes
it again by a hash join of its ids with the token-byte table, whose size is that of the vocabulary. A word is
sent once a block, so frequent words are no hot key. Texts are read and cut once; input whose order a retried
shuffle may change is written first.

Defined results: null counts as empty (no ids); repeated rows give repeated result rows; ids may be null;
no special tokens: their strings are ordinary text. Extra columns are not read. An empty table gives an empty
result. A text longer than a block is a block of its own. Decoding: null ids are empty; an id that the
vocabulary lacks raises KeyError.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, map_arrow, stable
from ._packed import Mail, Row, buckets, deal, owner, owners, pack, send, unpack

#: Bytes of text in a block: bounds the memory of a task.
BLOCK_BYTES = 32 << 20
#: Bytes at a word's beginning that it may share with the word before; bytes at its end that don't choose its owner,
#: so that words of one stem meet.
FRONT, TAIL = 16, 2
_ODD = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Bits of a source that tell the bucket to which a block's rows return.
HOME = 20


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.Table:
    """The token-byte table: id, bytes; and the id in decimal with a space after it."""
    table = ranks(path)
    ids = list(table.values())
    return pa.table({"id": pa.array(ids, pa.int32()), "bytes": pa.array(list(table), pa.binary()), "decimal": pa.array([b"%d " % i for i in ids], pa.binary())})


def join_tokens(ids: np.ndarray, path: str, column: str) -> tuple[bytes, np.ndarray]:
    """The ids joined with the token-byte table, by a hash join on id: a column's bytes one after another, and where
    each id's begin, with the end."""
    table = token_bytes(path)
    at = pc.index_in(pa.array(ids, pa.int32()), value_set=table["id"].combine_chunks())
    if at.null_count:
        raise KeyError(f"ids that the vocabulary lacks: {np.setdiff1d(ids, table['id'].to_numpy())[:5].tolist()}")
    found = table[column].combine_chunks().cast(pa.large_binary()).take(at)
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(pc.binary_length(found).to_numpy(), out=ends[1:])
    # What `take` made begins at its buffer's start and has no gaps.
    data = found.buffers()[2]
    return data.to_pybytes() if data is not None else b"", ends


def cut_words(text: str) -> list[str]:
    """Pieces whose tokens don't depend on their neighbours; together they are the text."""
    if not text:
        return []
    if _ODD.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    words = [" " + w for w in rest]
    return [first, *words] if first else words


# ---- Blocks


class _Numbers(dict):
    """Words' numbers, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray], list[str]]]:
    """(ids, word numbers of each text, words) of bounded size."""
    ids, positions, seen, size = [], [], _Numbers(), 0
    for batch in batches:
        for id_, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py() or ""
            ids.append(id_)
            words = cut_words(text)
            positions.append(np.fromiter(map(seen.__getitem__, words), np.uint32, len(words)))
            size += len(text) + 64
            if size >= BLOCK_BYTES:
                yield ids, positions, list(seen)
                ids, positions, seen, size = [], [], _Numbers(), 0
    if ids:
        yield ids, positions, list(seen)


def pack_words(words: list[bytes]) -> bytes:
    """Ascending words in one compressed value: how many bytes each shares with the one before, and has besides."""
    lengths = np.array(list(map(len, words)), dtype=np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum(lengths) - lengths
    # The first FRONT bytes of each word, side by side.
    at = starts[:, None] + np.arange(FRONT)
    inside = np.arange(FRONT) < lengths[:, None]
    heads = np.where(inside, raw[np.minimum(at, max(len(raw) - 1, 0))], 0) if len(raw) else np.zeros(at.shape, np.uint8)
    shared = np.zeros(len(words), np.uint8)
    shared[1:] = np.logical_and.accumulate((heads[1:] == heads[:-1]) & inside[1:] & inside[:-1], axis=1).sum(axis=1)
    rest = raw[np.arange(len(raw)) - np.repeat(starts, lengths) >= np.repeat(shared, lengths)]
    head = pack(shared, (lengths - shared).astype(np.uint32))
    return len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=3).compress(rest.tobytes())


def unpack_words(data: bytes) -> list[bytes]:
    n = 8 + int.from_bytes(data[:8], "little")
    shared, lengths = unpack(data[8:n])
    raw = zstandard.ZstdDecompressor().decompress(data[n:])
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    word, out = b"", []
    for k, a, b in zip(shared.tolist(), [0, *ends], ends, strict=False):
        word = word[:k] + raw[a:b]
        out.append(word)
    return out


def _in_pairs(ids: np.ndarray) -> bytes:
    """Ids of words in order: neighbours often begin alike, which a compressor sees if an id's bytes stay together."""
    ids = ids.astype(np.uint16 if not len(ids) or ids.max() < 1 << 16 else np.uint32)
    return ids.dtype.str.encode() + zstandard.ZstdCompressor(level=3).compress(ids.tobytes())


def _of_pairs(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), np.dtype(data[:3].decode()))


def _split(id_type: pa.DataType, parts: int):
    """Of each block: its words, for their owners; its texts, as words' numbers, for the task they return to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        task = TaskContext.get().partitionId()
        for number, (ids, positions, words) in enumerate(_blocks(batches)):
            home = (task + number) % parts
            source = (task << 20 | number) << HOME | home
            raw = [w.encode("utf-8", "surrogatepass") for w in words]
            to = owner(np.fromiter((xxhash.xxh64_intdigest(w[:-TAIL]) for w in raw), np.uint64, len(raw)), parts)
            # Words by owner, then in their own order; they are numbered anew by how often the block has them.
            order = np.array(sorted(range(len(raw)), key=raw.__getitem__), dtype=np.int64)
            order = order[np.argsort(to[order], kind="stable")]
            edges = np.searchsorted(to[order], np.arange(parts + 1)).tolist()
            for bucket in range(parts):
                mine = order[edges[bucket] : edges[bucket + 1]].tolist()
                if mine:
                    yield bucket, source, "words", pack_words([raw[k] for k in mine])
            flat = np.concatenate(positions)
            often = np.argsort(-np.bincount(flat, minlength=len(raw)), kind="stable")
            rank = np.empty(len(raw), np.uint32)
            rank[often] = np.arange(len(raw), dtype=np.uint32)
            place = np.empty(len(raw), np.int64)
            place[order] = np.arange(len(raw))
            sink = pa.BufferOutputStream()
            batch = pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], id_type), pa.array([len(p) for p in positions], pa.int64())], names=["id", "n"])
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield home, source, "ids", sink.getvalue().to_pybytes()
            yield home, source, "texts", pack(place[often].astype(np.uint32), rank[flat])

    return run


def _encode_words(path: str):
    """Each distinct word of a bucket encoded once; ids, and how many each word has, in the order of each request."""

    def run(bucket: int, mail: Mail) -> Iterator[Row]:
        for kind in ("ids", "texts"):
            for source, data in mail[kind]:
                yield bucket, source, kind, data
        encode, known = encoding(path).encode_ordinary, {}
        for source, data in mail["words"]:
            words = unpack_words(data)
            for w in words:
                if w not in known:
                    known[w] = encode(w.decode("utf-8", "surrogatepass"))
            ids = [known[w] for w in words]
            sizes = pack(np.array([bucket], np.uint32), np.array(list(map(len, ids)), dtype=np.uint32))
            yield source & (1 << HOME) - 1, source, "encoded", len(sizes).to_bytes(8, "little") + sizes + _in_pairs(np.array([i for x in ids for i in x], dtype=np.uint32))

    return run


def _reassemble(path: str, kinds: pa.Schema, ids_out: bool, decode: bool):
    """The blocks' texts by position, from the ids of their words."""

    def whole(held: bytes, texts: bytes, encoded: list[bytes]) -> Iterator[pa.RecordBatch]:
        batch = pa.ipc.open_stream(held).read_next_batch()
        place, numbers = unpack(texts)
        cut = [8 + int.from_bytes(e[:8], "little") for e in encoded]
        parts = sorted(((*unpack(e[8:n]), _of_pairs(e[n:])) for e, n in zip(encoded, cut, strict=True)), key=lambda c: c[0][0])
        sizes = np.concatenate([c[1] for c in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([c[2] for c in parts]) if parts else np.zeros(0, np.uint32)
        ends = np.cumsum(sizes)
        starts = ends - sizes

        def shown(column: str) -> list[bytes]:
            """Of each word, by how often the block has it, its ids' joined bytes."""
            data, at = join_tokens(flat, path, column)
            a, b = at[starts[place]].tolist(), at[ends[place]].tolist()
            return [data[x:y] for x, y in zip(a, b, strict=True)]

        decimal = shown("decimal")
        decoded = shown("bytes") if decode else []
        per_word = sizes[place]
        cols: dict[str, list] = {name: [] for name in kinds.names[1:]}
        at = 0
        for n in batch.column(1).to_pylist():
            mine = numbers[at : at + n]
            at += n
            words = mine.tolist()
            cols["n_tokens"].append(int(per_word[mine].sum()))
            cols["ids_sha256"].append(hashlib.sha256(b"".join([decimal[w] for w in words])[:-1]).hexdigest())
            if decode:
                cols["decoded_sha256"].append(hashlib.sha256(b"".join([decoded[w] for w in words])).hexdigest())
            if ids_out:
                a, size = starts[place[mine]], per_word[mine]
                take = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
                cols["ids"].append(flat[take].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(cols[f.name], f.type) for f in list(kinds)[1:])], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, list]] = {}

        def keep(bucket: int, mail: Mail) -> tuple:
            for kind, rows in mail.items():
                for source, data in rows:
                    held.setdefault(source, {}).setdefault(kind, []).append(data)
            return ()

        for _ in owners(keep)(batches):
            pass
        for source in sorted(held):
            one = held.pop(source)
            yield from whole(one["ids"][0], one["texts"][0], one.get("encoded", []))

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """One row per row of docs: id_col, n_tokens, ids_sha256; with_ids: ids array<int>;
    with_decoded: decoded_sha256, of the bytes that the ids decode to."""
    from pyspark.sql.pandas.types import to_arrow_type

    path = ranks_path or default_ranks()
    texts = stable(docs.select(col(id_col).alias("id"), col(text_col).alias("text")))
    kind = texts.schema["id"].dataType
    kinds = pa.schema([("id", to_arrow_type(kind)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), *[("decoded_sha256", pa.string())] * with_decoded, *[("ids", pa.list_(pa.int32()))] * with_ids])
    parts = buckets(texts)
    asked = deal(send(texts, _split(to_arrow_type(kind), parts)), parts=parts)
    answered = deal(send(asked, owners(_encode_words(path))), parts=parts)
    schema = f"id {kind.simpleString()}, n_tokens long, ids_sha256 string" + ", decoded_sha256 string" * with_decoded + ", ids array<int>" * with_ids
    return map_arrow(answered, _reassemble(path, kinds, with_ids, with_decoded), schema).withColumnRenamed("id", id_col)


def decode(ids: DataFrame, ids_col: str = "ids", out_col: str = "bytes", ranks_path: str | None = None) -> DataFrame:
    """ids with the bytes that each row's ids decode to in out_col (null ids: empty), by a hash join with the
    token-byte table, which is as large as the vocabulary, a fixed size, and held by each worker."""
    path = ranks_path or default_ranks()

    @F.pandas_udf("binary")
    def joined(column):
        import pandas as pd

        rows = [np.zeros(0, np.int32) if x is None else np.asarray(x, dtype=np.int32) for x in column]
        data, at = join_tokens(np.concatenate([np.zeros(0, np.int32), *rows]), path, "bytes")
        ends = at[np.cumsum([len(r) for r in rows], dtype=np.int64)].tolist() if rows else []
        return pd.Series([data[a:b] for a, b in zip([0, *ends], ends, strict=False)])

    from ..session import ship_package

    ship_package(ids.sparkSession)
    return ids.withColumn(out_col, joined(col(ids_col)))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Query: every whole text of documents encoded, and its ids decoded again."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False, with_decoded=True)
