"""Names that carry the order of files: serial numbers, object keys, identifiers, groups. Column expressions
with Python twins where the driver needs them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import ConfigError, NamingError

SEQ_BITS = 20
SEQ_MAX, EPOCH_MAX = (1 << 20) - 1, (1 << 43) - 1
#: epoch, seq, first and last offset, suffix.
BASENAME = r"^(\d+)-(\d+)-o(\d+)-(\d+)\.csv(\.gz)?$"
SEGMENT = r"^[A-Za-z0-9._-]{1,64}$"


def encode(epoch: int, seq: int) -> int:
    if not 0 <= epoch <= EPOCH_MAX or not 0 <= seq <= SEQ_MAX:
        raise NamingError(f"epoch {epoch}, seq {seq} are out of range")
    return epoch << SEQ_BITS | seq


def decode(serial: int) -> tuple[int, int]:
    return serial >> SEQ_BITS, serial & SEQ_MAX


def serial_seq(epoch: Column, seq: Column) -> Column:
    """Epoch and sequence in one long whose order is theirs; out of range fails the query."""
    fits = epoch.between(0, EPOCH_MAX) & seq.between(0, SEQ_MAX)
    return F.when(fits, F.shiftleft(epoch.cast("long"), SEQ_BITS).bitwiseOR(seq.cast("long"))).otherwise(F.raise_error(F.lit("epoch or seq is out of range")).cast("long"))


def try_serial(epoch: Column, seq: Column) -> Column:
    """As serial_seq; null where epoch or seq is out of range."""
    return F.when(epoch.between(0, EPOCH_MAX) & seq.between(0, SEQ_MAX), F.shiftleft(epoch.cast("long"), SEQ_BITS).bitwiseOR(seq.cast("long")))


def rolled_serial(epoch: Column, n: Column) -> Column:
    """The serial of the n-th file (from 0) of a writer that began at an epoch: it rolls to the next epoch whenever the sequence
    numbers of one are used up, so any count has a serial and order stays. Null counts have none."""
    count = n.cast("long")
    over = F.shiftright(count, SEQ_BITS)
    return F.when(count.isNotNull(), serial_seq(epoch.cast("long") + over, F.when(count >= 0, seq_of(count)).otherwise(count)))


def count_since(serial: Column, epoch: Column) -> Column:
    """The inverse of rolled_serial: how many serials lie between the epoch's first one and this."""
    return F.shiftleft(epoch_of(serial) - epoch.cast("long"), SEQ_BITS) + seq_of(serial)


def epoch_of(serial: Column) -> Column:
    return F.shiftrightunsigned(serial, SEQ_BITS)


def seq_of(serial: Column) -> Column:
    return serial.bitwiseAND(F.lit(SEQ_MAX).cast("long"))


def parse_basename(name: Column) -> Column:
    """A struct of epoch_ms, seq, start_offset, end_offset, compressed; null where it is no staged file's name."""
    part = lambda i: F.regexp_extract(name, BASENAME, i)
    epoch, start, end = (part(i).try_cast("long") for i in (1, 3, 4))
    seq = part(2).try_cast("long")
    good = name.rlike(BASENAME) & epoch.isNotNull() & start.isNotNull() & end.isNotNull() & seq.between(0, (1 << 32) - 1)
    return F.when(good, F.struct(epoch.alias("epoch_ms"), seq.alias("seq"), start.alias("start_offset"), end.alias("end_offset"), (part(5) != "").alias("compressed")))


def basename(epoch: Column, seq: Column, start: Column, end: Column, compressed: Column) -> Column:
    """Padded, so that names sort as their numbers; a longer number is never cut."""
    return F.concat(F.format_string("%013d-%07d-o%d-%d", epoch.cast("long"), seq.cast("long"), start.cast("long"), end.cast("long")), F.when(compressed, F.lit(".csv.gz")).otherwise(F.lit(".csv")))


def identifier(db: Column, rel: Column, writer: Column, epoch: Column, seq: Column) -> Column:
    text = F.concat_ws(":", *(c.cast("string") for c in (db, rel, writer, epoch, seq)))
    return F.when(F.octet_length(text) <= 128, text).otherwise(F.raise_error(F.lit("an identifier has at most 128 bytes")).cast("string"))


def serial_group(db: Column, rel: Column, writer: Column) -> Column:
    return F.concat_ws(":", db.cast("string"), rel.cast("string"), writer)


def staging_dir(cluster: Column, db: Column, rel: Column, writer: Column) -> Column:
    return F.concat_ws("/", cluster, db.cast("string"), rel.cast("string"), writer)


def good_segment(name: Column, writer: bool = False) -> Column:
    """Whether a name can be a path segment: 1 to 64 of A-Z a-z 0-9 . _ -, not only dots; a writer's not led by _."""
    good = name.rlike(SEGMENT) & ~name.rlike(r"^\.+$")
    return good & ~name.startswith("_") if writer else good


def check_segment(name: str, writer: bool = False) -> str:
    if not re.fullmatch(SEGMENT, name) or set(name) == {"."} or writer and name.startswith("_"):
        raise ConfigError(f"{name!r} can't be a path segment")
    return name


def next_epoch(now_ms: Column, largest: Column) -> Column:
    """The clock, unless it went back: then one past the largest epoch."""
    return F.when(now_ms <= largest, largest + 1).otherwise(now_ms)
