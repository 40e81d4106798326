"""The two-phase sink and the reader of staged files: edge values, kills between the phases, what is read at all."""

import csv
import gzip
import io
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.errors import StorageError
from weirline.functions import csv_dialect, naming
from weirline.sources import reader
from weirline.sources import sink as sink_module
from weirline.sources.sink import StagingSink
from weirline.sources.store import Store

ONE = T.StructType().add("s", "string")
TWO = T.StructType().add("i", "long").add("s", "string")


def files(root):
    return sorted(os.path.relpath(os.path.join(r, f), root) for r, _, fs in os.walk(root) for f in fs if f[0] not in "._")


def named(spark, rows, schema=TWO, name="i"):
    return spark.createDataFrame(rows, schema).withColumns({"name": F.concat(F.lit("p0/1-"), F.expr("i % 3").cast("string"), F.lit("-o0-9.csv.gz"))})


def rendered_rows(rows):
    return sink_module.rendered(rows, ["i", "s"], "name", ["i"])


@pytest.fixture()
def sink(spark, tmp_path):
    return StagingSink(Store(spark, str(tmp_path)))


def test_a_file_holds_its_rows_in_order_after_one_header(spark, sink, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("i"), F.concat(F.lit('a"\n,'), F.col("id").cast("string")).alias("s")).repartition(7)
    rows = rows.withColumn("name", F.concat(F.lit("p"), (F.col("i") % 5).cast("string"), F.lit("/1-0-o0-9.csv.gz")))
    made = sink.write(rows, ["i", "s"], "name", ["i"])
    assert [(m.name, m.n_rows) for m in made] == [(f"p{k}/1-0-o0-9.csv.gz", 4000) for k in range(5)] and files(tmp_path) == [m.name for m in made]
    for k, m in enumerate(made):
        data = gzip.open(tmp_path / m.name, "rb").read()
        assert len(data) == m.n_bytes and os.path.getsize(tmp_path / m.name) == m.stored_bytes
        assert data.decode() == '"i","s"\n' + "".join(f'{i},"a""\n,{i}"\n' for i in range(k, 20_000, 5))
    first = {m.name: (tmp_path / m.name).read_bytes() for m in made}
    sink.write(rows.repartition(2), ["i", "s"], "name", ["i"])
    assert first == {m.name: (tmp_path / m.name).read_bytes() for m in made} and files(tmp_path) == list(first)


def test_a_path_that_only_hadoop_opens(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.weir.link./data", f"file://{tmp_path}")
    rows = [(1, None), (2, ""), (3, "\\N"), (4, 'q"'), (5, "é\n"), (6, "x,y")]
    for compressed in (True, False):
        made = StagingSink(Store(spark, f"viewfs://weir/data/z{compressed}")).write(named(spark, rows), ["i", "s"], "name", ["i"], compressed=compressed)
        back = reader.read_files(spark, [f"viewfs://weir/data/z{compressed}/{m.name}" for m in made], TWO)
        assert sorted(map(tuple, back.select("i", "s").collect())) == rows
    assert [f for f in files(tmp_path) if "_" in f] == []


def test_a_failed_task_leaves_nothing(spark, sink, tmp_path):
    rows = named(spark, [(k, "x") for k in range(9)]).withColumn("s", F.when(F.col("i") == 7, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("s")))
    with pytest.raises(Exception, match="broken row"):
        sink.write(rows, ["i", "s"], "name", ["i"])
    assert files(tmp_path) == []


def test_an_attempt_that_was_not_committed_never_happened(spark, sink, tmp_path):
    sink.prepare(rendered_rows(named(spark, [(1, "a"), (2, "b")])))
    assert not [f for f in files(tmp_path) if not f.startswith("_attempts")]
    assert sink.recover() == [] and files(tmp_path) == [] and not list((tmp_path / "_attempts").iterdir())


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_a_driver_that_dies_between_the_moves(spark, sink, tmp_path, monkeypatch, moves):
    rows = named(spark, [(k, f"v{k}") for k in range(30)])
    attempt = sink.prepare(rendered_rows(rows))
    real, left = sink.store.move, [moves]

    def move(a, b):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(a, b)

    monkeypatch.setattr(sink.store, "move", move)
    if moves < 3:
        with pytest.raises(KeyboardInterrupt):
            sink.commit(attempt)
    else:
        monkeypatch.setattr(sink.store, "delete", lambda _: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sink.commit(attempt)
    # The files that are there are a prefix; the next driver ends the rest, once.
    there = [f.name for f in attempt.files if (tmp_path / f.name).exists()]
    assert there == [f.name for f in attempt.files][:moves]
    again = StagingSink(Store(spark, str(tmp_path)))
    assert again.recover() == [f.name for f in attempt.files] and again.recover() == []
    assert files(tmp_path) == [f.name for f in attempt.files]
    back = reader.read_files(spark, [f"{tmp_path}/{f.name}" for f in attempt.files], TWO)
    assert sorted(map(tuple, back.select("i", "s").collect())) == [(k, f"v{k}") for k in range(30)]


def test_an_answer_that_was_lost_is_no_failure(spark, sink, monkeypatch):
    real = sink.store.move

    def move(a, b):
        real(a, b)
        raise StorageError("timed out")

    monkeypatch.setattr(sink.store, "move", move)
    made = sink.write(named(spark, [(1, "a")]), ["i", "s"], "name", ["i"])
    assert sink.store.exists(made[0].name)


@pytest.mark.parametrize("name", ["../up", "a/../b", "a//b", "/a", "a/", "", ".", "a b", None])
def test_names_that_lead_elsewhere_are_refused(spark, sink, tmp_path, name):
    rows = spark.createDataFrame([(1, "x")], TWO).withColumn("name", F.lit(name).cast("string"))
    with pytest.raises(Exception, match="no name for a staged file"):
        sink.write(rows, ["i", "s"], "name", ["i"])
    assert files(tmp_path) == []


def test_no_rows_no_files(spark, sink, tmp_path):
    assert sink.write(named(spark, []), ["i", "s"], "name", ["i"]) == [] and files(tmp_path) == []


def test_tables_of_one_column_keep_their_nulls(spark, sink, tmp_path):
    data = [(None,), ("",), (None,), ("a\n",), (None,)]
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(data)], "k int, s string").withColumn("name", F.lit("1-0-o0-4.csv"))
    made = sink.write(rows, ["s"], "name", ["k"], compressed=False)
    assert (tmp_path / made[0].name).read_text() == '"s"\n\n""\n\n"a\n"\n\n'
    got = reader.read_files(spark, [f"{tmp_path}/{made[0].name}"], ONE).orderBy("_ord").collect()
    assert [(r.s,) for r in got] == data and [r._ord for r in got] == [0, 1, 2, 3, 4]


def put(path, text, how="gzip"):
    data = text.encode()
    if how == "members":
        data = b"".join(gzip.compress(data[i : i + 7]) for i in range(0, len(data), 7))
    path.write_bytes(gzip.compress(data) if how == "gzip" else data)


def test_gzip_is_known_by_its_first_bytes(spark, tmp_path):
    text = '"i","s"\n1,"a"\n2,\n'
    for k, how in enumerate(("gzip", "members", "plain")):
        put(tmp_path / f"1-{k}-o0-1.csv{'.gz' if how == 'plain' else ''}", text, how)
    got = reader.read_staged(spark, str(tmp_path), TWO).select("_serial", "_ord", "i", "s").collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == [(naming.encode(1, k), o, o + 1, "a" if o == 0 else None) for k in range(3) for o in range(2)]


@pytest.mark.parametrize(("text", "how"), [('"i","s"\n1\n', "plain"), ('"i","s"\n1,"a","b"\n', "plain"), ('"i","s"\n1,"a\n', "plain"), ('"i","s"\n1,"a\n2,b"\n3\n', "plain")])
def test_damaged_files_are_errors(spark, tmp_path, text, how):
    put(tmp_path / "1-0-o0-1.csv", text, how)
    with pytest.raises(Exception, match="is damaged"):
        reader.read_staged(spark, str(tmp_path), TWO).collect()


def test_a_gzip_file_that_was_cut_off_is_an_error(spark, tmp_path):
    (tmp_path / "1-0-o0-1.csv.gz").write_bytes(gzip.compress(b'"i","s"\n' + b'1,"a"\n' * 50)[:-9])
    with pytest.raises(Exception, match="is damaged"):
        reader.read_staged(spark, str(tmp_path), TWO).collect()


def opened(frame):
    """The rows, and how many files the scans opened for them."""
    rows = frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return rows, sum(m.get().value() for m in found if m.isDefined())


def test_files_outside_the_range_are_not_opened(spark, tmp_path):
    for k in range(20):
        put(tmp_path / f"{1 + k // 10}-{k % 10}-o{k * 10}-{k * 10 + 9}.csv.gz", f'"i","s"\n{k},"v"\n')
    (tmp_path / "4-99999999999-o0-1.csv.gz").write_bytes(b"no number fits")
    (tmp_path / "notes.txt").write_bytes(b"no staged file")
    whole, n = opened(reader.read_staged(spark, str(tmp_path), TWO))
    assert sorted(r.i for r in whole) == list(range(20)) and n == 20
    some, n = opened(reader.read_staged(spark, str(tmp_path), TWO, offsets=(45, 80)))
    assert sorted((r.i, r._start, r._end) for r in some) == [(k, 10 * k, 10 * k + 9) for k in range(4, 9)] and n == 5
    late, n = opened(reader.read_staged(spark, str(tmp_path), TWO, above=naming.encode(1, 8), upto=naming.encode(2, 1)))
    assert sorted(r.i for r in late) == [9, 10, 11] and n == 3
    assert reader.read_staged(spark, str(tmp_path), TWO, offsets=(1000, None)).collect() == []


def rendered(rows, delimiter):
    cells = lambda r: delimiter.join("" if c is None else '"' + c.replace('"', '""') + '"' for c in r)
    return "".join(cells(r) + "\n" for r in rows)


@settings(max_examples=200, deadline=None)
@given(st_.integers(1, 4).flatmap(lambda w: st_.lists(st_.tuples(*[st_.none() | st_.text('a",;é\n€\\N', max_size=6)] * w), min_size=0, max_size=8)), st_.integers(1, 40), st_.sampled_from([",", ";", "€", "é"]))
def test_splitting_in_blocks_of_any_size_undoes_the_dialect(rows, block, delimiter):
    width = len(rows[0]) if rows else 2
    data = (csv_dialect.header_text([f"c{k}" for k in range(width)], delimiter) + "\n" + rendered(rows, delimiter)).encode()
    for blocks in ([data[i : i + block] for i in range(0, len(data), block)], reader.inflate(memoryview(gzip.compress(data)), block)):
        parts = list(reader.records(iter(blocks), width, delimiter.encode()))
        assert [tuple(r) for p in parts for r in zip(*(c.to_pylist() for c in p), strict=True)] == rows
    if delimiter == "," and rows and all(c is not None for r in rows for c in r):
        assert [tuple(r) for r in csv.reader(io.StringIO(rendered(rows, ","), newline=""))] == rows


def test_a_file_costs_an_attempt_one_folder(spark, sink, tmp_path):
    attempt = sink.prepare(rendered_rows(named(spark, [(k, str(k)) for k in range(9)])))
    made = [p for p in (tmp_path / "_attempts" / attempt.ident).rglob("*") if p.is_dir()]
    assert len(made) == len(attempt.files) and all(f.stored_bytes == (tmp_path / f.held).stat().st_size for f in attempt.files)


def test_a_move_over_a_file_is_read_by_its_own_checksum(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.put("a/x", "before")
    store.put("b/x", "after")
    store.move("b/x", "a/x")
    assert store.get("a/x") == "after" and not any((tmp_path / "b").iterdir()) and (tmp_path / "a" / ".x.crc").exists()
    os.unlink(tmp_path / "a" / ".x.crc")
    store.put("b/y", "with a checksum")
    store.move("a/x", "b/y")
    assert store.get("b/y") == "after"
    with pytest.raises(StorageError):
        store.move("a/none", "b/y")
    assert store.get("b/y") == "after"


def test_small_files_share_a_batch():
    import pyarrow as pa

    from weirline.sources.reader import gathered

    batches = [pa.RecordBatch.from_pydict({"k": [i, i + 1]}) for i in range(0, 50, 2)]
    out = list(gathered(iter(batches), rows=20))
    assert [x for b in out for x in b.column(0).to_pylist()] == list(range(50)) and [b.num_rows for b in out] == [20, 20, 10]
    assert list(gathered(iter([]))) == []


@pytest.mark.parametrize("compressed", [True, False])
def test_on_a_local_disk_a_file_is_one_object(spark, sink, tmp_path, compressed):
    # Hadoop's writer leaves a checksum beside each, and starts a process for either.
    rows = rendered_rows(named(spark, [(k, "é\n" * k) for k in range(50)]))
    attempt = sink.prepare(rows, compressed)
    there = [str(p.relative_to(tmp_path)) for p in (tmp_path / "_attempts" / attempt.ident).rglob("*") if p.is_file()]
    assert sorted(there) == sorted(f.held for f in attempt.files) and len(there) == 3
    for k, f in enumerate(attempt.files):
        data = (tmp_path / f.held).read_bytes()
        want = '"i","s"\n' + "".join(f'{i},"' + "é\n" * i + '"\n' for i in range(k, 50, 3))
        assert (gzip.decompress(data) if compressed else data).decode() == want
        assert (f.n_rows, f.n_bytes, f.stored_bytes) == (len(range(k, 50, 3)), len(want.encode()), len(data))
