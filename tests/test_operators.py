"""Operators on small fixtures, and every registered query against its SQL."""

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from weirline.operators import folds, ledger, tables
from weirline.plans.queries import ORACLE, QUERIES


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_last_wins_takes_whole_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, None, 2), (None, "x", 3), (None, "y", 4)], "id int, v string, o int")
    assert rows(tables.last_wins(df, ["id"], F.col("o"))) == sorted([(1, None, 2), (2, "b", 1), (None, "y", 4)], key=repr)


def test_composite_keys_are_not_mixed_up(spark):
    df = spark.createDataFrame([(b"a", b"bc", 0), (b"ab", b"c", 1), (b"\x00\xff", b"", 2), (b"\x00\xff", b"", 3)], "a binary, b binary, o int")
    assert sorted(r.o for r in tables.last_wins(df, ["a", "b"], F.col("o")).collect()) == [0, 1, 3]


def test_last_wins_is_idempotent(spark, sf):
    from weirline.plans.stream import stream

    df = stream(spark, sf).select("user_id", "offset", "event_id", "p")
    once = tables.last_wins(df, ["user_id"], F.col("offset"))
    assert rows(once) == rows(tables.last_wins(once, ["user_id"], F.col("offset")))


def test_upsert_matches_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n"), (3, "c")], "id int, v string")
    d = spark.createDataFrame([(None, "N"), (1, "A"), (9, "z")], "id int, v string")
    assert rows(tables.upsert(t, d, ["id"])) == sorted([(3, "c"), (None, "N"), (1, "A"), (9, "z")], key=repr)


FILES = [("g", 100, 5, 0, 999), ("g", 200, 0, 1000, 1499), ("g", 100, 6, 1500, 1999)]


def test_recovery_spans_epochs_and_prunes_by_the_watermark(spark):
    from weirline.functions.naming import encode

    f = spark.createDataFrame([(*x, encode(x[1], x[2])) for x in FILES], "serial_group string, epoch_ms long, seq long, start_offset long, end_offset long, serial_seq long")
    none = spark.createDataFrame([], "serial_group string, watermark long")
    r = ledger.recovery(f, none).first()
    assert (r.next_offset, r.max_epoch, r.max_seq) == (2000, 200, 0) and r.backfill == sorted(encode(a, b) for _, a, b, *_ in FILES)
    mark = spark.createDataFrame([("g", encode(100, 6))], "serial_group string, watermark long")
    state = spark.createDataFrame([("g", 2499)], "serial_group string, resume_offset long")
    r = ledger.recovery(f, mark, state).first()
    assert r.next_offset == 2500 and r.backfill == [encode(200, 0)]
    top = spark.createDataFrame([("g", encode(300, 0))], "serial_group string, watermark long")
    assert ledger.recovery(f, top).first().backfill == []


def test_lag(spark):
    now = 1_000_000
    f = spark.createDataFrame([("g", 10, now - 90000), ("g", 11, now - 60000), ("g", 12, now - 5000), ("h", 1, now + 5000)], "serial_group string, serial_seq long, sealed_at_ms long")
    at = lambda w: {r.serial_group: (r.lag_files, r.lag_seconds) for r in ledger.lag(f, spark.createDataFrame([("g", w)], "serial_group string, watermark long"), now).collect()}
    assert at(10) == {"g": (2, 60), "h": (1, 0)} and at(12)["g"] == (0, 0) and at(9)["g"] == (3, 90)


def test_order_breaks(spark):
    def broken(*files):
        df = spark.createDataFrame([("g", i, e, s, 10 * i) for i, (e, s) in enumerate(files)], "serial_group string, arrival long, epoch_ms long, seq long, end_offset long")
        return ledger.order_breaks(df).count()

    assert broken((5, 7), (5, 8)) == 0 and broken((5, 7), (6, 0)) == 0
    assert broken((5, 7), (5, 9)) == 1 and broken((5, 7), (6, 1)) == 1 and broken((5, 7), (5, 7)) == 1 and broken((5, 7), (4, 0)) == 1


def test_clean_up_budget_and_unknown_watermark(spark):
    f = spark.createDataFrame([("g", i, i, 0) for i in range(10)] + [("h", i, i, 0) for i in range(10)], "serial_group string, serial_seq long, epoch_ms long, seq long")
    mark = spark.createDataFrame([("g", 7)], "serial_group string, watermark long")
    gone = lambda **k: sorted(r.serial_seq for r in ledger.deletable(f, mark, 100, **k).collect())
    assert gone(retain_ms=50, retain_min=0) == list(range(8)) and gone(retain_ms=50, retain_min=6) == [0, 1, 2, 3] and gone(retain_ms=95, retain_min=0) == [0, 1, 2, 3, 4] and gone(retain_ms=50, retain_min=10) == []


def test_folds():
    import pandas as pd

    assert folds.accepted_offsets([(0, 9), (5, 12), (20, 29), (13, 15), (-1, 3), (30, 29), (30, 30)]) == [True, False, True, False, False, False, True]
    batches = pd.DataFrame({"n_rows": [10, 10, 10, 10, 10], "n_bytes": [100, 100, 100, 100, 100]})
    # 128 bytes a row at first, 10 after a file has been seen.
    assert folds.cut_files(batches, 2000) == [0, 0, 1, 1, 1] and folds.cut_files(batches, 1) == [0, 1, 2, 3, 4]


def test_gate(spark):
    book = spark.createDataFrame([("g", 1, "a", "FINISH"), ("g", 2, "b", "READY")], "serial_group string, serial_seq long, identifier string, status string")
    jobs = spark.createDataFrame([("g", 1, "z"), ("g", 2, "b"), ("g", 2, "c"), ("g", 3, "d"), ("h", 1, "e")], "serial_group string, serial_seq long, identifier string")
    assert {r.identifier: r.verdict for r in ledger.gate(jobs, book).collect()} == {"z": "replay", "b": "replay", "c": "violation", "d": "accept", "e": "accept"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        found = glob.glob(f"{sf}/{t}.parquet/*.parquet") or [f"{sf}/{t}.parquet"]
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({found!r})")
    return con


def plain(v):
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = sorted(tuple(map(plain, r)) for r in df.select(*sorted(df.columns)).collect())
    if name not in ORACLE:
        assert got
        return
    rel = duck.sql(ORACLE[name])
    at = [rel.columns.index(c) for c in sorted(df.columns)]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_rest_works_without_the_training_data_subpackage():
    """The entry module's guard: nothing else names the subpackage."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "weirline"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "weirline.llm" not in f.read_text() and "from .llm" not in f.read_text() and "from ..llm" not in f.read_text(), f
