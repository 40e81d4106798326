"""Media columns: Netpbm and BMP images as arrays, area-resized tiles in NPY form, difference hashes.

Images are decoded to numpy arrays without other libraries. Area resizing goes by integral images:
each output sample is the exact mean of the input area it covers, fractions of border samples
included. Tiles are written in the NPY format; the difference hash compares neighbours of a 9 x 8 tile.

Defined results: null media gives null outputs; malformed media raises ValueError in the functions and
gives null outputs with the reason in `error` in the column operator; null text counts as empty and is
stored as 64 zero bytes; repeated rows give repeated result rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import col, map_arrow

#: Pixels of the largest image that is decoded: a header may promise any number.
MOST_SAMPLES = 1 << 30
#: Samples in a row of a stored payload.
ROW = 64
_TOKEN = re.compile(rb"\s*(?:#[^\n\r]*[\n\r]\s*)*(\d+)")


def encode_netpbm(image: np.ndarray) -> bytes:
    """uint8 array, (h, w) as P5 or (h, w, 3) as P6."""
    if image.dtype != np.uint8 or image.ndim not in (2, 3) or image.ndim == 3 and image.shape[2] != 3:
        raise ValueError("uint8 samples of one or three channels are asked for")
    kind = b"P5" if image.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + image.tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6, 8 or 16 bits a sample, as (h, w) or (h, w, 3)."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("no Netpbm image")
    numbers, at = [], 2
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("a Netpbm header that ends early")
        numbers.append(int(m[1]))
        at = m.end()
    w, h, top = (*numbers, 1)[:3]
    if w < 1 or h < 1 or w * h > MOST_SAMPLES or not 0 < top < 65536:
        raise ValueError("a Netpbm header out of range")
    depth = 3 if kind in (b"P3", b"P6") else 1
    n = w * h * depth
    if kind == b"P1":
        bits = re.sub(rb"#[^\n\r]*|\s+", b"", data[at:])[:n]
        if bits.strip(b"01"):
            raise ValueError("Netpbm bits other than 0 and 1")
        values = 1 - (np.frombuffer(bits, np.uint8) - 48)
    elif kind in (b"P2", b"P3"):
        held = re.sub(rb"#[^\n\r]*", b"", data[at:]).split()[:n]
        if not all(x.isdigit() and len(x) < 9 for x in held):
            raise ValueError("Netpbm samples that are no numbers")
        values = np.array(list(map(int, held)), dtype=np.int64)
    else:
        body = data[at + 1 :]
        if kind == b"P4":
            rows = np.frombuffer(body[: (w + 7) // 8 * h], np.uint8)
            if len(rows) == (w + 7) // 8 * h:
                rows = rows.reshape(h, -1)
            else:
                raise ValueError("Netpbm samples that end early")
            values = 1 - np.unpackbits(rows, axis=1)[:, :w].ravel()
        else:
            size = 2 if top > 255 else 1
            values = np.frombuffer(body[: n * size], ">u2" if size == 2 else np.uint8)
    if len(values) != n:
        raise ValueError("Netpbm samples that end early")
    if n and int(values.max()) > top:
        raise ValueError("a Netpbm sample beyond the largest")
    values = values.astype(np.uint8 if top < 256 else np.uint16, copy=False)
    return values.reshape((h, w, 3) if depth == 3 else (h, w))


def encode_bmp(image: np.ndarray) -> bytes:
    """uint8 array as a bottom-up BMP: (h, w) with a grey palette of 8 bits, (h, w, 3) with 24 bits."""
    h, w = image.shape[:2]
    body = image if image.ndim == 2 else image[:, :, ::-1]
    line = w * (1 if image.ndim == 2 else 3)
    pad = -line % 4
    rows = np.zeros((h, line + pad), np.uint8)
    rows[:, :line] = body[::-1].reshape(h, line)
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if image.ndim == 2 else b""
    start = 54 + len(palette)
    head = b"BM" + struct.pack("<IHHI", start + rows.size, 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8 if image.ndim == 2 else 24, 0, rows.size, 2835, 2835, len(palette) // 4, 0)
    return head + info + palette + rows.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits; a grey palette gives (h, w), else (h, w, 3)."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("no BMP image")
    start, = struct.unpack_from("<I", data, 10)
    size, w, h, _, bits, packed = struct.unpack_from("<IiiHHI", data, 14)
    if size < 40 or packed not in (0, 3) or packed == 3 and bits != 32 or bits not in (1, 4, 8, 24, 32) or w < 1 or not h or w * abs(h) > MOST_SAMPLES:
        raise ValueError("a BMP of a form that is not supported")
    used, = struct.unpack_from("<I", data, 46)
    line = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data[start : start + line * abs(h)], np.uint8)
    if len(rows) != line * abs(h):
        raise ValueError("BMP samples that end early")
    rows = rows.reshape(abs(h), line)
    rows = rows[::-1] if h > 0 else rows
    if bits >= 24:
        return np.ascontiguousarray(rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1])
    held = data[14 + size : 14 + size + 4 * min(used or 1 << bits, 1 << bits)]
    if len(held) % 4 or not held:
        raise ValueError("a BMP palette that ends early")
    palette = np.frombuffer(held, np.uint8).reshape(-1, 4)[:, 2::-1]
    if bits == 8:
        index = rows[:, :w]
    elif bits == 4:
        index = np.stack([rows >> 4, rows & 15], axis=2).reshape(abs(h), -1)[:, :w]
    else:
        index = np.unpackbits(rows, axis=1)[:, :w]
    if int(index.max()) >= len(palette):
        raise ValueError("a BMP sample beyond the palette")
    colours = palette[index]
    return np.ascontiguousarray(colours[:, :, 0]) if (palette == palette[:, :1]).all() else colours


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def grey(image: np.ndarray) -> np.ndarray:
    """Luminance of an image, as float64."""
    return image.astype(np.float64) if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means of the areas that each output sample covers, by an integral image; float64 (height, width)."""
    h, w = image.shape
    total = np.zeros((h + 1, w + 1))
    np.cumsum(np.cumsum(image, axis=0, dtype=np.float64), axis=1, out=total[1:, 1:])

    def lines(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(m + 1) * n / m
        low = np.minimum(at.astype(np.int64), n - 1)
        return low, low + 1, at - low

    y0, y1, fy = lines(h, height)
    x0, x1, fx = lines(w, width)
    rows = total[y0] * (1 - fy)[:, None] + total[y1] * fy[:, None]
    grid = rows[:, x0] * (1 - fx) + rows[:, x1] * fx
    sums = grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]
    return sums / ((h / height) * (w / width))


def difference_hash(image: np.ndarray) -> int:
    """64 bits: whether each of 8 x 8 samples of a 9 wide tile is darker than its right neighbour."""
    tile = np.round(area_resize(image, 8, 9), 6)
    return int.from_bytes(np.packbits(tile[:, :-1] < tile[:, 1:]).tobytes(), "big")


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, tile, version=(1, 0), allow_pickle=False)
    return out.getvalue()


def tile_of(image: np.ndarray, size: int = 32) -> np.ndarray:
    return np.clip(np.rint(area_resize(grey(image), size, size)), 0, 255).astype(np.uint8)


def media_tiles(media: DataFrame, id_col: str, media_col: str, size: int = 32) -> DataFrame:
    """One row per row of media: id_col, height, width, channels, tile (NPY bytes), dhash (hex), error."""
    from pyspark.sql.pandas.types import to_arrow_type

    picked = media.select(col(id_col).alias("id"), col(media_col).cast("binary").alias("media"))
    kind = picked.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(1):
                data = data.as_py()
                row: dict = dict.fromkeys(("height", "width", "channels", "tile", "dhash", "error"))
                if data is not None:
                    try:
                        image = decode(data)
                        row |= {"height": image.shape[0], "width": image.shape[1], "channels": 1 if image.ndim == 2 else 3, "tile": npy(tile_of(image, size)), "dhash": f"{difference_hash(grey(image)):016x}"}
                    except (ValueError, struct.error, IndexError, OverflowError, MemoryError) as e:
                        row["error"] = str(e) or type(e).__name__
                rows.append(row)
            kinds = [("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("tile", pa.binary()), ("dhash", pa.string()), ("error", pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), *(pa.array([r[k] for r in rows], t) for k, t in kinds)], names=["id", *(k for k, _ in kinds)])

    out = map_arrow(picked, run, f"id {kind.simpleString()}, height int, width int, channels int, tile binary, dhash string, error string")
    return out.withColumnRenamed("id", id_col)


def store_text(text: str | None) -> tuple[int, bytes]:
    """A text as a grey image of 64 columns, its bytes padded with zeros: (unpadded bytes, PGM)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    padded = raw + bytes(-len(raw) % ROW or (0 if raw else ROW))
    return len(raw), encode_netpbm(np.frombuffer(padded, np.uint8).reshape(-1, ROW))


_STORED = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("tile_sha256", pa.string())]


def _stored_row(text: str | None) -> tuple:
    n, media = store_text(text)
    image = decode(media)
    payload = image.tobytes()
    seen = grey(image)
    tile = npy(np.clip(np.rint(area_resize(seen, 32, 32)), 0, 255).astype(np.uint8))
    return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"{difference_hash(seen):016x}", hashlib.sha256(tile).hexdigest()


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the digests of the text stored as a PGM and read back, its difference
    hash (feature) and the digest of its NPY tile."""
    from pyspark.sql.pandas.types import to_arrow_type

    picked = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    kind = picked.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_stored_row(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), *(pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_STORED))], names=["id", *(k for k, _ in _STORED)])

    out = map_arrow(picked, run, f"id {kind.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile_sha256 string")
    return out.withColumnRenamed("id", id_col)


def op9_media(spark, sf_dir: str) -> DataFrame:
    """Query: every whole text of documents stored as a PGM, read back, hashed and tiled."""
    return text_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
