"""Writers and streams on a local root: round trips, replays, crashes, leases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.config import Compression, Config, Mode
from weirline.errors import ConfigError, DatabaseError, RotationFailed, SchemaError, SerialContractViolation, StagingStalled, StorageError, WriterClosed, WriterFenced, WriterLocked
from weirline.sources import staging
from weirline.sources.push import ReplaySource
from weirline.sources.store import Store
from weirline.streaming import pipeline
from weirline.streaming.lease import Lease
from weirline.streaming.writer import Engine, check_order, plan_recovery
from weirline.types import TableSchema

COLUMNS = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
SCHEMA = TableSchema(COLUMNS, ("id",), 13727, 54321)


def config(tmp_path, **more):
    settings = {"retry_max": 0, "lock_wait": 0, "lock_settle": 0, "staging_error_after_attempts": 1, "ticker": False}
    return Config(str(tmp_path), buckets=4, **(settings | more))


def batch(spark, *pairs):
    return spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "id long, name string, _ord long")


def content(writer):
    return sorted(map(tuple, writer.target.read().collect()), key=repr)


def test_files_round_trip_with_edge_values(spark, tmp_path):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType()), T.StructField("f", T.DoubleType()), T.StructField("y", T.BinaryType()), T.StructField("t", T.TimestampNTZType()), T.StructField("n", T.DecimalType(38, 3))])
    import decimal

    data = [(1, 'a"b\n,c', True, 1e21, b"\x00\xff", dt.datetime(1969, 12, 31, 23, 59, 59, 999999), decimal.Decimal("0.001")), (2, "", False, float("-inf"), b"", None, None), (3, None, None, None, None, None, None), (4, "\\N", True, 1e-7, b"a", None, decimal.Decimal(10) ** 34)]
    df = spark.createDataFrame(data, schema).withColumns({"uri": F.concat(F.lit(f"file://{tmp_path}/f"), (F.col("i") % 2).cast("string"), F.lit(".csv.gz"))})
    made = staging.write_files(df, schema.names, "uri", ["i"]).collect()
    assert sorted(m.n_rows for m in made) == [2, 2]
    first = {m.uri: open(m.uri[7:], "rb").read() for m in made}
    staging.write_files(df.repartition(3), schema.names, "uri", ["i"]).collect()
    assert first == {m.uri: open(m.uri[7:], "rb").read() for m in made}, "a retry gives the same bytes"
    back = staging.read_files(spark, [m.uri for m in made], schema).select(*schema.names)
    assert sorted(map(tuple, back.collect())) == sorted(data)
    with pytest.raises(SchemaError):
        staging.read_files(spark, ["x"], T.StructType([]))


def test_listing_tells_strange_names_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for name in ("1-2-o3-4.csv", "1-1-o0-2.csv.gz", "x.csv", "99999999999999999999-1-o0-1.csv"):
        store.put(f"d/{name}", "x")
    store.put("d/sub/1-9-o9-9.csv", "x")
    staged, odd = staging.list_staged(store, "d")
    assert [(f["seq"], f["compressed"]) for f in staged] == [(1, True), (2, False)] and sorted(odd) == ["99999999999999999999-1-o0-1.csv", "x.csv"]
    store.put("bad.json", "{")
    with pytest.raises(StorageError):
        store.get_json("bad.json")
    assert store.get_json("none.json") is None


def test_upsert_writer(spark, tmp_path):
    engine = Engine(spark, config(tmp_path))
    w, plan = engine.open_table("public.t", SCHEMA, "w-0")
    assert plan.next_offset is None and plan.backfill == []
    w.append(batch(spark, (1, "a"), (2, "b"), (1, "c")), 0, 2)
    w.append(batch(spark, (2, "d"), (3, None)), 10, 11)
    assert w.flush() == 11 and content(w) == sorted([(1, "c"), (2, "d"), (3, None)], key=repr)
    with pytest.raises(ConfigError):
        w.append(batch(spark, (1, "x")), 11, 12)
    with pytest.raises(SchemaError):
        w.append(spark.range(1), 20, 21)
    w.append(batch(spark, (3, "")), 20, 20)
    w.close()
    assert content(w) == sorted([(1, "c"), (2, "d"), (3, "")], key=repr)
    with pytest.raises(WriterClosed):
        w.append(batch(spark, (1, "x")), 30, 31)
    names = [n for n, _ in Store(spark, str(tmp_path)).list(w.folder)]
    assert len(names) == 2 and names[0].endswith("-o0-11.csv.gz") and names[1].endswith("-0000001-o20-20.csv.gz")
    again, plan = engine.open_table("public.t", SCHEMA, "w-0")
    assert plan.next_offset == 21 and plan.backfill == [] and again.epoch > w.epoch
    assert again.lag().lag_files == 0
    again.close()


def test_crash_between_staging_and_load_is_mended(spark, tmp_path, monkeypatch):
    engine = Engine(spark, config(tmp_path, compression=Compression.NONE))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")), 0, 0)
    w.flush()
    monkeypatch.setattr(w, "_load", lambda *_: (_ for _ in ()).throw(StorageError("crash")))
    w.append(batch(spark, (1, "b"), (2, "x")), 1, 2)
    with pytest.raises(DatabaseError):
        w.flush()
    assert content(w) == [(1, "a")] and isinstance(w.fatal_error(), DatabaseError)
    w.abandon()
    again, plan = engine.open_table("t", SCHEMA, "w-0")
    assert [f["seq"] for f in plan.backfill] == [1] and plan.next_offset == 3 and content(again) == [(1, "b"), (2, "x")]
    again._announce(plan.backfill[0])
    assert content(again) == [(1, "b"), (2, "x")]
    again.close()


def test_insert_only_keeps_copies_and_replays_once(spark, tmp_path):
    w, _ = Engine(spark, config(tmp_path, mode=Mode.INSERT_ONLY)).open_table("t", TableSchema(COLUMNS, (), 1, 2), "w-0")
    w.append(batch(spark, (1, "a"), (1, "a")), 0, 1)
    w.flush()
    w._announce(w._last_file)
    assert content(w) == [(1, "a"), (1, "a")]
    w.close()


def test_rotation_by_size(spark, tmp_path):
    w, _ = Engine(spark, config(tmp_path, rotate_size_bytes=300)).open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a"), (2, "b")), 0, 1)
    assert w.staged_offset is None
    w.append(batch(spark, (3, "c")), 2, 2)
    assert w.staged_offset == 2
    w.close()


def test_lease(spark, tmp_path):
    store, now = Store(spark, str(tmp_path)), [1000.0]
    a = Lease(store, "l.json", 180, clock=lambda: now[0], settle=0)
    b = Lease(store, "l.json", 180, clock=lambda: now[0], settle=0)
    a.acquire()
    with pytest.raises(WriterLocked):
        b.acquire()
    now[0] += 181
    b.acquire()
    with pytest.raises(WriterFenced):
        a.heartbeat()
    a.release()
    b.verify()
    b.release()
    assert store.get_json("l.json") is None
    store.put("l.json", json.dumps(a.owner | {"pid": 2**22 - 3, "heartbeat": now[0]}))
    b.acquire()
    b.release()


def test_recovery_plan_and_order():
    files = [{"epoch_ms": e, "seq": s, "start_offset": a, "end_offset": b} for e, s, a, b in ((100, 5, 0, 999), (200, 0, 1000, 1499), (100, 6, 1500, 1999))]
    plan = plan_recovery(files, None)
    assert plan.next_offset == 2000 and plan.top == (200, 0) and len(plan.backfill) == 3
    assert plan_recovery([], None).next_offset is None and plan_recovery([], None, 7).next_offset == 8
    assert plan_recovery(files, 200 << 20).backfill == []
    check_order(None, files[0])
    check_order(files[0], files[2])
    with pytest.raises(Exception, match="missing"):
        check_order(files[0], files[0] | {"seq": 7})


@pytest.mark.parametrize("mode", [Mode.UPSERT, Mode.INSERT_ONLY])
def test_stream_end_to_end_and_restart(spark, tmp_path, mode):
    spark.dataSource.register(ReplaySource)
    schema = SCHEMA if mode is Mode.UPSERT else TableSchema(COLUMNS, (), 13727, 54321)
    cfg = config(tmp_path, mode=mode)

    def go(total):
        source = spark.readStream.format("weirline_replay").options(partitions="2", per_poll="30", total=str(total), keys="25").load()
        q = pipeline.start(source, cfg, schema, 1_704_067_200_000, str(tmp_path / "check"), trigger={"processingTime": "0 seconds"})
        q.processAllAvailable()
        q.stop()

    go(60)
    go(90)
    from weirline.streaming.target import Target

    rows = [tuple(r) for r in Target(spark, f"{tmp_path}/tables/13727/54321", COLUMNS, schema.key, 4).read().collect()]
    if mode is Mode.INSERT_ONLY:
        assert len(rows) == 180
    else:
        want = {p * 1_000_000 + o % 25: f"name-{p}-{o}" for p in range(2) for o in range(90)}
        assert dict(rows) == want and len(rows) == 50
    names = [n for n, _ in Store(spark, str(tmp_path)).list("staging/c0/13727/54321/p0")]
    assert len(names) >= 3 and names[0].startswith("1704067200000-0000000-o0-")


def test_catalog(spark, tmp_path):
    from weirline.sources.catalog import fetch_schema

    spark.sql(f"CREATE TABLE keyed (id BIGINT, name STRING) USING parquet LOCATION '{tmp_path}/keyed' TBLPROPERTIES ('weirline.primary_key' = 'id')")
    try:
        s = fetch_schema(spark, "keyed")
        assert s.key == ("id",) and s.columns.names == ["id", "name"]
    finally:
        spark.sql("DROP TABLE keyed")
    with pytest.raises(SchemaError):
        fetch_schema(spark, "nothing.here")


# ---- Nothing taken is lost


def broken(n, e=OSError("the store is away")):
    """A stand-in for a method that fails n times, then does what it did."""

    def wrap(real):
        left = [n]

        def call(*args, **kwargs):
            if left[0]:
                left[0] -= 1
                raise e
            return real(*args, **kwargs)

        return call

    return wrap


def reopened(engine):
    again, plan = engine.open_table("t", SCHEMA, "w-0")
    out = content(again), plan, again.staged_offset
    again.close()
    return out


def test_a_file_that_fails_to_stage_keeps_its_rows_and_its_name(spark, tmp_path, monkeypatch):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    monkeypatch.setattr(w, "_stage", broken(2)(w._stage))
    w.append(batch(spark, (1, "a")), 0, 0)
    for attempts in (1, 2):
        with pytest.raises(StagingStalled):
            w.flush()
        assert w.fatal_error() is None and w.staged_offset is None and w.progress.attempts == attempts and "o0-0" in w.progress.failing
    w.append(batch(spark, (2, "b")), 1, 1)
    assert w.flush() == 1 and w.progress.failing is None and content(w) == [(1, "a"), (2, "b")]
    assert [n.split("-", 1)[1] for n, _ in w.store.list(w.folder)] == ["0000000-o0-0.csv.gz", "0000001-o1-1.csv.gz"]
    w.close()


def test_staging_is_tried_again_with_longer_pauses(spark, tmp_path, monkeypatch):
    slept = []
    engine = Engine(spark, config(tmp_path, staging_error_after_attempts=4), sleep=slept.append)
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    monkeypatch.setattr(w, "_stage", broken(3)(w._stage))
    w.append(batch(spark, (1, "a")), 0, 0)
    assert w.flush() == 0 and slept == [1.0, 2.0, 4.0]
    monkeypatch.setattr(w, "_stage", broken(1, SchemaError("no such type"))(w._stage))
    w.append(batch(spark, (2, "b")), 1, 1)
    with pytest.raises(RotationFailed):
        w.flush()
    assert isinstance(w.fatal_error(), RotationFailed), "what can't succeed isn't tried again"
    w.abandon()


def test_nothing_is_taken_while_the_queue_is_full(spark, tmp_path, monkeypatch):
    w, _ = Engine(spark, config(tmp_path, rotate_size_bytes=1, rotation_queue_depth=2)).open_table("t", SCHEMA, "w-0")
    real = w._stage
    monkeypatch.setattr(w, "_stage", broken(99)(real))
    for k in range(2):
        w.append(batch(spark, (k, "x")), k, k)
    with pytest.raises(StagingStalled):
        w.append(batch(spark, (2, "x")), 2, 2)
    assert len(w._sealed) == 2 and not w._buffer and w._top == 1
    monkeypatch.setattr(w, "_stage", real)
    w.append(batch(spark, (2, "x")), 2, 2)
    assert content(w) == [(0, "x"), (1, "x"), (2, "x")]
    w.close()


@pytest.mark.parametrize("times", [1, 99])
def test_a_load_that_fails_blocks_its_group(spark, tmp_path, monkeypatch, times):
    slept = []
    engine = Engine(spark, config(tmp_path, retry_max=2), sleep=slept.append)
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    monkeypatch.setattr(w, "_load", broken(times, RuntimeError("no engine error"))(w._load))
    w.append(batch(spark, (1, "a")), 0, 0)
    if times == 1:
        assert w.flush() == 0 and slept == [1.0] and content(w) == [(1, "a")] and [j["status_name"] for j in w.jobs()] == ["FINISH"]
        w.close()
        return
    with pytest.raises(DatabaseError):
        w.flush()
    assert slept == [1.0, 2.0] and isinstance(w.fatal_error(), DatabaseError) and w.staged_offset == 0
    monkeypatch.undo()
    with pytest.raises(DatabaseError):
        w.append(batch(spark, (2, "b")), 1, 1)
    with pytest.raises(DatabaseError):
        w.flush()
    assert w.target.applied(w.serial_group) == -1 and [(j["status_name"], j["attempts"], j["retry_max"], j["add_by"]) for j in w.jobs()] == [("FAIL", 3, 2, 4)]
    w.abandon()
    rows, plan, end = reopened(engine)
    assert rows == [(1, "a")] and [f["seq"] for f in plan.backfill] == [0] and end == 0


def test_a_staged_file_that_vanished_is_an_error(spark, tmp_path, monkeypatch):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    real = w._announce
    monkeypatch.setattr(w, "_announce", lambda f: w.store.delete(f"{w.folder}/{[n for n, _ in w.store.list(w.folder)][-1]}") and real(f))
    w.append(batch(spark, (1, "a")), 0, 0)
    with pytest.raises(DatabaseError, match="is gone"):
        w.flush()
    w.abandon()


def test_a_vanished_file_is_not_tried_again(spark, tmp_path, monkeypatch):
    slept = []
    w, _ = Engine(spark, config(tmp_path, retry_max=15), sleep=slept.append).open_table("t", SCHEMA, "w-0")
    monkeypatch.setattr(w.store, "exists", lambda key: False if key.endswith(".csv.gz") else True)
    w.append(batch(spark, (1, "a")), 0, 0)
    with pytest.raises(DatabaseError, match="is gone"):
        w.flush()
    assert slept == [] and [j["status_name"] for j in w.jobs()] == ["FAIL"]
    monkeypatch.undo()
    w.abandon()


@pytest.mark.parametrize("times", [1, 2, 99])
def test_a_store_that_does_not_answer_is_asked_again(spark, tmp_path, monkeypatch, times):
    slept = []
    engine = Engine(spark, config(tmp_path, staging_error_after_attempts=3), sleep=slept.append)
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    monkeypatch.setattr(w, "_book", broken(times, StorageError("timed out"))(w._book))
    w.append(batch(spark, (1, "a")), 0, 0)
    if times == 99:
        for attempts in (3, 6):
            with pytest.raises(StagingStalled):
                w.flush()
            assert w.fatal_error() is None and w.progress.attempts == attempts and "o0-0" in w.progress.failing
        monkeypatch.undo()
    assert w.flush() == 0 and w.fatal_error() is None and w.progress.failing is None and content(w) == [(1, "a")]
    assert times == 99 or slept == [1.0, 2.0][:times]
    w.close()


def test_the_saved_offset_only_advances(spark, tmp_path):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    saved = lambda: w.store.get_json(w._state_key)["resume_offset"]
    w._save_state(7)
    w._save_state(None)
    assert saved() == 7
    w._save_state(3)
    assert saved() == 7
    w.abandon()
    again, plan = engine.open_table("t", SCHEMA, "w-0")
    assert plan.next_offset == 8
    again._save_state(None)
    assert saved() == 7
    again.abandon()


def test_a_writer_is_forgotten_but_not_its_files(spark, tmp_path):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")), 0, 3)
    w.flush()
    w._save_state(99)
    with pytest.raises(WriterLocked):
        engine.forget_writer(SCHEMA, "w-0")
    w.abandon()
    assert engine.forget_writer(SCHEMA, "w-0") and not engine.forget_writer(SCHEMA, "w-0")
    with pytest.raises(ConfigError):
        engine.forget_writer(SCHEMA, "../w")
    rows, plan, end = reopened(engine)
    assert rows == [(1, "a")] and plan.next_offset == 4


class Remote:
    """A store whose move is a copy: what Hadoop's S3 and others look like from here."""

    def __init__(self, real, conditional):
        self.real, self.conditional = real, conditional

    def __getattr__(self, name):
        return getattr(self.real, name)

    def getUri(self):  # noqa: N802
        return type("Uri", (), {"getScheme": lambda _: "s3a"})()

    def hasPathCapability(self, path, name):  # noqa: N802
        return self.conditional

    def createFile(self, target):  # noqa: N802
        real = self.real

        class Builder:
            def must(self, name, value):
                assert (name, value) == ("fs.option.create.conditional.overwrite", True)
                return self

            recursive = lambda self: self
            build = lambda self: real.create(target, False)

        return Builder()


def test_objects_are_created_once_or_not_at_all(spark, tmp_path):
    for conditional in (True, False):
        store = Store(spark, str(tmp_path / str(conditional)))
        store._fs, store._local = Remote(store._fs, conditional), False
        if not conditional:
            with pytest.raises(StorageError, match="only where there is none"):
                store.create("a/b.json", "1")
            assert not store.exists("a/b.json")
            continue
        assert store.create("a/b.json", "1") and not store.create("a/b.json", "2") and store.get("a/b.json") == "1"


@pytest.mark.parametrize("bad", ["../../x", "a b"])
def test_a_stream_with_odd_partitions_and_clashing_columns(spark, tmp_path, bad):
    columns = T.StructType().add("id", "long").add("offset", "long").add("partition", "string")
    schema = TableSchema(columns, ("id",), 3, 4)
    folder = tmp_path / "in"
    rows = [(1, 0, "0"), (1, 1, "0"), (2, 0, None), (3, 0, "1")]
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(folder))

    def go():
        q = pipeline.start(spark.readStream.schema(columns).parquet(str(folder)), config(tmp_path), schema, 1_704_067_200_000, str(tmp_path / "check"), trigger={"availableNow": True})
        q.awaitTermination()

    go()
    from weirline.streaming.target import Target

    target = Target(spark, f"{tmp_path}/tables/3/4", columns, schema.key, 4)
    assert sorted(map(tuple, target.read().collect()), key=repr) == [(1, 1, "0"), (2, 0, None), (3, 0, "1")]
    assert [n for n, _ in Store(spark, str(tmp_path)).folders("staging/c0/3/4") if n[0] != "_"] == ["null", "p0", "p1"]
    spark.createDataFrame([(9, 5, bad), (9, 5, "0")], columns).coalesce(1).write.mode("append").parquet(str(folder))
    with pytest.raises(Exception, match="path segment"):
        go()
    assert target.read().count() == 3 and not (tmp_path / "staging/x").exists()


def test_a_batch_without_rows_moves_the_offset(spark, tmp_path):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")).limit(0), 0, 9)
    assert w.flush() == 9
    w.abandon()
    assert reopened(engine)[2] == 9


def test_a_gap_in_the_jobs_and_a_wrong_identity_are_refused(spark, tmp_path):
    engine = Engine(spark, config(tmp_path))
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")), 0, 0)
    w.flush()
    w._book((w.epoch << 20) + 1, "another", {"end_offset": 1, "epoch_ms": w.epoch, "seq": 1, "start_offset": 1, "compressed": True}, "READY", 0)
    w.append(batch(spark, (1, "b")), 1, 1)
    with pytest.raises(SerialContractViolation):
        w.flush()
    w.abandon()
    state = json.loads(w.store.get(w._state_key))
    w.store.put(w._state_key, json.dumps(state | {"writer_id": "other"}))
    with pytest.raises(ConfigError, match="writer_id"):
        engine.open_table("t", SCHEMA, "w-0")
    assert w.store.get_json(f"{w.folder}/_meta/lease.json") is None, "a failed opening releases the lease"


def test_numbers_roll_over_into_the_next_epoch(spark, tmp_path):
    w, _ = Engine(spark, config(tmp_path)).open_table("t", SCHEMA, "w-0")
    epoch, w.seq = w.epoch, (1 << 20) - 1
    for k in range(2):
        w.append(batch(spark, (k, "a")), k, k)
        w.flush()
    assert (w.epoch, w.seq) == (epoch + 1, 1) and len(content(w)) == 2
    w.close()


def test_chores(spark, tmp_path):
    now = [1_700_000_000.0]
    cfg = config(tmp_path, rotate_interval_max=15.0, gc_retain_min_files=3, gc_retain_days=1)
    engine = Engine(spark, cfg, clock=lambda: now[0])
    w, _ = engine.open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")), 0, 0)
    now[0] += 14
    w.tick()
    assert w.staged_offset is None
    now[0] += 2
    w.tick()
    assert w.staged_offset == 0, "sealed by age, without another batch"
    beat = w.store.get_json(f"{w.folder}/_meta/lease.json")["heartbeat"]
    now[0] += 31
    w.tick()
    assert w.store.get_json(f"{w.folder}/_meta/lease.json")["heartbeat"] == now[0] > beat and w._lag.sampled_at == now[0]
    for k in range(1, 6):
        w.append(batch(spark, (k, "a")), k, k)
        w.flush()
    now[0] += 2 * 86400
    w.lease.heartbeat()
    w.tick()
    assert len(w.store.list(w.folder)) == 3 and len(w.jobs()) == 3 and w.store.get_json(w._state_key)["resume_offset"] == 5
    w.store.put(f"{w.folder}/_meta/lease.json", json.dumps({"uuid": "another", "host": "h", "pid": 1, "heartbeat": now[0]}))
    now[0] += 60
    with pytest.raises(WriterFenced):
        w.tick()
    with pytest.raises(WriterFenced):
        w.append(batch(spark, (9, "a")), 99, 99)
    w.abandon()


def test_the_ticker_seals_by_itself(spark, tmp_path):
    import time

    w, _ = Engine(spark, config(tmp_path, rotate_interval_max=1.0, ticker=True)).open_table("t", SCHEMA, "w-0")
    w.append(batch(spark, (1, "a")), 0, 0)
    for _ in range(100):
        if w.staged_offset == 0:
            break
        time.sleep(0.2)
    assert w.staged_offset == 0
    w.close()
    assert not w._thread.is_alive()


def test_opening_waits_for_a_lease_and_takes_a_stale_one(spark, tmp_path):
    now, store = [1000.0], Store(spark, str(tmp_path))
    clock = lambda: now[0]
    sleep = lambda s: now.__setitem__(0, now[0] + s)
    a = Lease(store, "l.json", 180, clock)
    a.acquire()
    with pytest.raises(WriterLocked):
        Lease(store, "l.json", 180, clock, wait=10, sleep=sleep).acquire()
    assert now[0] == 1010
    b = Lease(store, "l.json", 180, clock, wait=600, sleep=sleep)
    b.acquire()
    assert 1180 < now[0] < 1190
    with pytest.raises(WriterFenced):
        a.verify()
    b.release()


# ---- The target table


def test_two_writers_of_one_table(spark, tmp_path):
    engines = [Engine(spark, config(tmp_path)) for _ in range(2)]
    a, b = (e.open_table("t", SCHEMA, f"w-{k}")[0] for k, e in enumerate(engines))
    for k in range(3):
        for at, w in enumerate((a, b)):
            w.append(batch(spark, (1000 * at + k, "x"), (1000 * at, f"r{k}")), 10 * k, 10 * k + 1)
            w.flush()
    assert content(a) == content(b) == sorted([(0, "r2"), (1, "x"), (2, "x"), (1000, "r2"), (1001, "x"), (1002, "x")], key=repr)
    a.close()
    b.close()


def table(spark, tmp_path, buckets=4):
    from weirline.streaming.target import Target

    return Target(spark, f"{tmp_path}/t", COLUMNS, ("id",), buckets)


def test_commits_that_meet_lose_nothing(spark, tmp_path, monkeypatch):
    a, b = table(spark, tmp_path), table(spark, tmp_path, 7)
    rows = lambda *p: spark.createDataFrame(p, COLUMNS)
    a.upsert(rows((1, "a"), (2, "a")), {"g": 0})
    write = a._write

    def slow(df):  # while a writes its part, b commits
        folder = write(df)
        b.upsert(rows((2, "b"), (3, "b")), {"h": 5})
        monkeypatch.setattr(a, "_write", write)
        return folder

    monkeypatch.setattr(a, "_write", slow)
    a.upsert(rows((3, "a"), (4, "a")), {"g": 1})
    assert sorted(map(tuple, a.read().collect())) == [(1, "a"), (2, "b"), (3, "a"), (4, "a")]
    assert a.manifest()["applied"] == {"g": 1, "h": 5}
    b.upsert(rows((1, "again")), {"h": 5})
    assert (1, "again") not in list(map(tuple, a.read().collect()))


def test_a_crash_before_the_commit_leaves_the_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    rows = lambda *p: spark.createDataFrame(p, COLUMNS)
    t.upsert(rows((1, "a")), {"g": 0})
    monkeypatch.setattr(t.store, "create", broken(1)(t.store.create))
    with pytest.raises(OSError, match="away"):
        t.upsert(rows((1, "b")), {"g": 1})
    assert list(map(tuple, t.read().collect())) == [(1, "a")] and t.applied("g") == 0
    t.upsert(rows((1, "b")), {"g": 1})
    assert list(map(tuple, t.read().collect())) == [(1, "b")]
    assert len(t.vacuum(10**15)) == 1 and list(map(tuple, t.read().collect())) == [(1, "b")]
    for name, _ in t.store.list("manifests"):
        t.store.delete(f"manifests/{name}")
    with pytest.raises(StorageError, match="no manifest"):
        t.read()


def test_parts_are_merged_by_levels(spark, tmp_path, monkeypatch):
    from weirline.streaming import target

    monkeypatch.setattr(target, "FANOUT", 2)
    t, want = table(spark, tmp_path), {}
    for k in range(7):
        want |= {k: f"v{k}", 0: f"zero{k}"}
        t.upsert(spark.createDataFrame([(k, f"v{k}"), (0, f"zero{k}")][k == 0 :], COLUMNS), {"g": k})
        assert dict(map(tuple, t.read().collect())) == want
    assert [p["level"] for p in t.manifest()["parts"]] == [2, 1, 0]


def test_store_replaces_and_creates_whole_objects(spark, tmp_path):
    from weirline.sources.store import normal_root

    s = Store(spark, f"{tmp_path}//x/")
    s.put("k", "one")
    s.put("k", "two")
    assert s.get("k") == "two" and not s.create("k", "three") and s.create("new", "four") and s.get("new") == "four" and s.get("none") is None
    assert [n for n, _ in s.list("")] == ["k", "new"]
    assert normal_root("s3://e//b/p//") == "s3://e/b/p" and normal_root("/a//b/") == "/a/b"
