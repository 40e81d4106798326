"""The lag board: fed by a sink and by the progress of a running stream."""

import time

import pytest
from pyspark.sql import types as T

from weirline.sources.staged_source import staged_stream
from weirline.sources.store import Store
from weirline.streaming import lag, rotation
from weirline.streaming.staged_stream import StagedStream
from weirline.types import TableSchema

COLUMNS = T.StructType().add("id", "long").add("name", "string")
EPOCH = 1_704_067_200_000


def test_files_wait_until_they_are_taken():
    now = [100.0]
    board = lag.LagBoard(clock=lambda: now[0])
    board.sealed([("p0", 1, 0), ("p0", 1, 1), ("p1", 1, 0)])
    now[0] = 107.5
    board.sealed([("p0", 1, 1), ("p0", 2, 0)])
    assert board.rows() == [("p0", 3, 7, None, None), ("p1", 1, 7, None, None)]
    board.taken({"p0": "1:1"})
    now[0] = 110.0
    assert board.rows() == [("p0", 1, 2, 1, 1), ("p1", 1, 10, None, None)]
    # What is told again, late or twice, changes nothing.
    board.taken({"p0": "1:0", "p2": "5:5"})
    board.sealed([("p0", 1, 0), ("p2", 5, 5)])
    assert board.rows() == [("p0", 1, 2, 1, 1), ("p1", 1, 10, None, None), ("p2", 0, 0, 5, 5)]


def test_a_running_stream_feeds_the_board(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "lake"))
    board = lag.LagBoard()
    sink = StagedStream(store, "staging/t", TableSchema(COLUMNS, ("id",), 7, 8), EPOCH, board=board)
    for batch in range(3):
        rows = [(f"p{p}", batch, 10 * batch, 10 * batch + 9, "size", o, str(o), f'{o},"a"') for p in range(2) for o in range(10 * batch, 10 * batch + 10)]
        sink.write(spark.createDataFrame(rows, rotation.SEALED), batch)
    assert [r[:2] for r in board.rows()] == [("p0", 3), ("p1", 3)]
    monkeypatch.setattr(Store, "list", lambda *_: pytest.fail("a folder was listed"))
    monkeypatch.setattr(Store, "walk", lambda *_: pytest.fail("a folder was listed"))
    spark.streams.addListener(board)
    try:
        stream = lag.observed(staged_stream(spark, str(tmp_path / "lake/staging/t"), COLUMNS, files_per_trigger=1))
        q = stream.writeStream.format("noop").queryName("consumer").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        deadline = time.time() + 30
        while any(r[1] for r in board.rows()) and time.time() < deadline:
            time.sleep(0.2)
        q.stop()
    finally:
        spark.streams.removeListener(board)
    assert [tuple(r) for r in board.lag(spark).collect()] == [("p0", 0, 0, EPOCH, 2), ("p1", 0, 0, EPOCH, 2)]
    seen = [r for r in board.progress(spark).collect() if r.n_rows]
    assert [(r.query, r.n_rows, r.oldest_epoch_ms) for r in seen] == [("consumer", 20, EPOCH)] * 3
