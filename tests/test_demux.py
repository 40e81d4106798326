"""One stream into tables of different columns and modes."""

import json

import pytest
from pyspark.sql import types as T

from weirline.config import Mode
from weirline.errors import ConfigError, SchemaError
from weirline.sources.store import Store
from weirline.streaming.demux import Demux, Route
from weirline.types import TableSchema

USERS = TableSchema(T.StructType().add("id", "long").add("name", "string").add("score", "double"), ("id",), 1, 10)
CLICKS = TableSchema(T.StructType().add("url", "string").add("at", T.TimestampNTZType()), (), 1, 11)
ROUTES = {"users": Route(USERS), "clicks": Route(CLICKS, Mode.INSERT_ONLY)}
INPUT = "tag string, partition string, offset long, value string"
EPOCH = 1_704_067_200_000


@pytest.fixture()
def demux(spark, tmp_path):
    return Demux(spark, Store(spark, str(tmp_path)), "staging", ROUTES, EPOCH)


def row(tag, partition, offset, **values):
    return tag, partition, offset, json.dumps(values)


ROWS = [
    row("users", "0", 0, id=1, name="a", score=0.5), row("users", "0", 1, id=1, name='b"\n,', score=None), row("users", None, 5, id=2, name=""), row("users", "1", 0, id=3, name="c", score=1e21, other=1),
    row("clicks", "0", 2, url="/x", at="2024-01-01T00:00:00"), row("clicks", "0", 3, url="/x", at="2024-01-01T00:00:00"), row("clicks", None, 0, url=None),
]


def content(demux, tag):
    return sorted((tuple(r) for r in demux.targets[tag].read().collect()), key=repr)


def names(root):
    return sorted(str(f.relative_to(root)) for f in root.rglob("*.csv.gz") if not f.name.startswith("."))


def test_rows_go_by_their_tag(spark, demux, tmp_path):
    made = demux.write(spark.createDataFrame(ROWS, INPUT), 3)
    assert [(f["tag"], f["stream"], f["start_offset"], f["end_offset"], f["n_rows"]) for f in made] == [("clicks", "null", 0, 0, 1), ("clicks", "p0", 2, 3, 2), ("users", "null", 5, 5, 1), ("users", "p0", 0, 1, 1), ("users", "p1", 0, 0, 1)]
    assert names(tmp_path / "staging") == sorted(f["object"] for f in made) == sorted(r.object for r in demux.ledger().collect())
    demux.load(made)
    demux.load(demux.write(spark.createDataFrame([], INPUT), 3))
    users = [(1, 'b"\n,', None), (2, "", None), (3, "c", 1e21)]
    assert content(demux, "users") == users and [r[0] for r in content(demux, "clicks")] == ["/x", "/x", None]


@pytest.mark.parametrize(("bad", "error"), [(row("other", "0", 9, id=1), "no table for the tag"), ((None, "0", 9, "{}"), "no table for the tag"), (row("users", "../../x", 9, id=1), "path segment"), (row("users", "a/b", 9, id=1), "path segment"), (("users", "0", 9, "{no json"), "don't parse at offset 9"), (("users", "0", 9, None), "don't parse"), (row("users", "0", -1, id=1), "no offset"), (row("users", "0", 9, id="text"), "don't parse")])
def test_what_belongs_nowhere_stops_the_micro_batch_whole(spark, demux, tmp_path, bad, error):
    with pytest.raises(Exception, match=error):
        demux.write(spark.createDataFrame([*ROWS, bad], INPUT), 0)
    assert names(tmp_path) == [] and demux.ledger().count() == 0
    demux.load(demux.write(spark.createDataFrame(ROWS, INPUT), 0))
    assert len(content(demux, "users")) == 3


def test_a_stream_of_two_tables_over_a_crash(spark, demux, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(4):
        rows = [row("users", str(o % 2), o, id=o % 5, name=f"n{o}") for o in range(k * 10, k * 10 + 10)] + [row("clicks", "0", o, url=f"/{o % 3}") for o in range(k * 4, k * 4 + 4)]
        spark.createDataFrame(rows, INPUT).coalesce(1).write.mode("append").parquet(str(folder))

    def go(d):
        source = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", 1).parquet(str(folder))
        d.start(source, str(tmp_path / "check"), {"availableNow": True}).awaitTermination()

    left = [5]
    real = demux.store.move

    def dies(a, b):
        left[0] -= 1
        if left[0] < 0:
            raise KeyError("killed")
        real(a, b)

    monkeypatch.setattr(demux.sink.store, "move", dies)
    with pytest.raises(Exception, match="killed"):
        go(demux)
    again = Demux(spark, Store(spark, str(tmp_path)), "staging", ROUTES, EPOCH)
    go(again)
    assert len(content(again, "clicks")) == 16
    newest = {k: max(o for o in range(40) if o % 5 == k and o % 2 == p) for k in range(5) for p in (0, 1)}
    got = content(again, "users")
    assert [r[0] for r in got] == list(range(5)) and all(int(r[1][1:]) % 5 == r[0] and int(r[1][1:]) >= 30 for r in got) and newest
    assert sorted(r.object for r in again.ledger().collect()) == names(tmp_path / "staging")


def test_settings(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for routes in ({}, {"a": Route(USERS), "b": Route(USERS)}):
        with pytest.raises(ConfigError):
            Demux(spark, store, "s", routes, EPOCH)
    with pytest.raises(SchemaError):
        Demux(spark, store, "s", {"a": Route(CLICKS, Mode.UPSERT)}, EPOCH)
