"""The stream of staged files: planned by names, limited by stream, the same files again after a crash."""

import gzip

import pytest
from pyspark.sql import types as T

from weirline.errors import ConfigError
from weirline.sources import staged_source as src

TWO = T.StructType().add("i", "long").add("s", "string")


def put(folder, stream, seq, n=3, epoch=1):
    (folder / stream).mkdir(parents=True, exist_ok=True)
    rows = [(seq * 100 + k, None if k == 1 else f'{stream}"{k}') for k in range(n)]
    text = '"i","s"\n' + "".join(f"{i}," + ("" if s is None else '"' + s.replace('"', '""') + '"') + "\n" for i, s in rows)
    (folder / stream / f"{epoch}-{seq}-o{seq * 100}-{seq * 100 + n - 1}.csv.gz").write_bytes(gzip.compress(text.encode()))
    return [(stream, epoch, seq, *r) for r in rows]


def reader(folder, **limits):
    return src.StagedReader({"path": str(folder), "width": "2"} | {k: str(v) for k, v in limits.items()})


def run(spark, folder, checkpoint, batches, fail_at=None, **limits):
    """Take what is there; the rows of each micro-batch by its number."""

    def one(df, batch_id):
        batches[batch_id] = sorted((r._stream, r._epoch, r._seq, r.i, r.s) for r in df.collect())
        if batch_id == fail_at:
            raise KeyError("killed")

    frame = src.staged_stream(spark, str(folder), TWO, **limits)
    q = frame.writeStream.foreachBatch(one).option("checkpointLocation", str(checkpoint)).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_each_stream_gives_what_it_may(tmp_path):
    for k in range(5):
        put(tmp_path, "p0", k)
    put(tmp_path, "p1", 0)
    put(tmp_path, "_attempts", 7)
    (tmp_path / "p1" / "notes.txt").write_text("x")
    r = reader(tmp_path, files_per_trigger=2)
    end = r.latestOffset()
    assert end == {"p0": "1:1", "p1": "1:0"}
    assert sorted((p.stream, p.seq) for p in r.partitions({}, end)) == [("p0", 0), ("p0", 1), ("p1", 0)]
    assert r.latestOffset() == {"p0": "1:3", "p1": "1:0"}


def test_bytes_limit_a_trigger_but_never_stop_it(tmp_path):
    put(tmp_path, "p0", 0, n=500)
    put(tmp_path, "p0", 1, n=1)
    put(tmp_path, "p0", 2, n=1)
    r = reader(tmp_path, bytes_per_trigger=200)
    first = r.latestOffset()
    assert first == {"p0": "1:0"}
    r.partitions({}, first)
    assert r.latestOffset() == {"p0": "1:2"}
    with pytest.raises(ConfigError):
        reader(tmp_path, files_per_trigger=0)


def test_a_reader_that_starts_again_catches_up(tmp_path):
    for k in range(6):
        put(tmp_path, "p0", k)
    r = reader(tmp_path, files_per_trigger=2)
    # Spark stands at file 3, which this reader can't know: it is asked again where nothing was new.
    assert [r.latestOffset()["p0"] for _ in range(3)] == ["1:1", "1:3", "1:5"]
    assert [p.seq for p in r.partitions({"p0": "1:3"}, {"p0": "1:5"})] == [4, 5]


def test_rows_come_once_and_in_files(spark, tmp_path):
    want = [r for s in ("p0", "p1") for k in range(5) for r in put(tmp_path / "in", s, k)]
    batches = {}
    run(spark, tmp_path / "in", tmp_path / "check", batches, files_per_trigger=2)
    got = sorted(r for b in batches.values() for r in b)
    assert got == sorted(want) and max(len({(r[0], r[2]) for r in b}) for b in batches.values()) == 4
    # After a restart only what is new.
    more = put(tmp_path / "in", "p1", 5) + put(tmp_path / "in", "p2", 0)
    later = {}
    run(spark, tmp_path / "in", tmp_path / "check", later, files_per_trigger=2)
    assert sorted(r for b in later.values() for r in b) == sorted(more)


def test_a_crash_gives_the_same_files_again(spark, tmp_path):
    want = [r for k in range(6) for r in put(tmp_path / "in", "p0", k)]
    first, again = {}, {}
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path / "in", tmp_path / "check", first, fail_at=1, files_per_trigger=2)
    want += put(tmp_path / "in", "p0", 6)
    run(spark, tmp_path / "in", tmp_path / "check", again, files_per_trigger=2)
    assert min(again) == 1 and again[1] == first[1]
    assert sorted(first[0] + [r for b in again.values() for r in b]) == sorted(want)


def test_hadoop_settings_reach_s3(monkeypatch):
    seen = {}
    monkeypatch.setattr(src.pafs, "S3FileSystem", lambda **k: seen.update(k) or "fs")
    assert src.open_store("s3a://bucket/a/b/", {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "e:9", "path": "x"}) == ("fs", "bucket/a/b")
    assert seen == {"access_key": "k", "secret_key": "s", "endpoint_override": "e:9"}
