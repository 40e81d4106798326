"""Stateful rotation against the batch fold, across restarts and without input; the exactly-once sink, killed anywhere."""

import gzip
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.errors import ConfigError
from weirline.functions import csv_dialect as csv
from weirline.operators.folds import cut_files
from weirline.sources import reader
from weirline.sources.store import Store
from weirline.streaming import rotation
from weirline.streaming.staged_stream import StagedStream
from weirline.types import TableSchema

COLUMNS = T.StructType().add("id", "long").add("name", "string")
SCHEMA = TableSchema(COLUMNS, ("id",), 7, 8)
INPUT = "partition int, offset long, id long, name string"
EPOCH = 1_704_067_200_000


@pytest.fixture(autouse=True)
def provider(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", rotation.PROVIDER)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows_of(n, partitions=(0, 1), keys=7):
    """Rows of every partition; texts of different lengths, some that need quoting."""
    return [(p, o, o % keys, "x" * (o * 13 % 40) + ('"\n' if o % 5 == 0 else "")) for o in range(n) for p in partitions]


def feed(spark, folder, rows, parts):
    """Write rows as `parts` files in the order of offsets, each a trigger's worth, after those that are there."""
    folder.mkdir(exist_ok=True)
    at = len(list(folder.glob("*.parquet")))
    for k in range(parts):
        chunk = rows[k * len(rows) // parts : (k + 1) * len(rows) // parts]
        frame = pd.DataFrame(chunk, columns=["partition", "offset", "id", "name"]).astype({"partition": "Int32"})
        frame.sample(frac=1.0, random_state=k).to_parquet(folder / f"{at + k:05d}.parquet", index=False)


def source(spark, folder):
    return spark.readStream.schema(INPUT).option("maxFilesPerTrigger", 1).parquet(str(folder))


NOW = {"processingTime": "0 seconds"}


def settle(q, folder, seconds=90):
    """Wait until all files are taken; a query with timers never has nothing to do."""
    last, deadline = len(list(folder.glob("*.parquet"))) - 1, time.time() + seconds
    try:
        while time.time() < deadline:
            if q.exception() is not None:
                raise q.exception()
            p = q.lastProgress
            end = p and p["sources"][0]["endOffset"]
            if end and int(re.search(r"logOffset\D+(\d+)", str(end))[1]) >= last:
                return
            time.sleep(0.1)
        pytest.fail("the files were not taken in time")
    finally:
        q.stop()


def run(spark, folder, checkpoint, limit=700, age=3600.0, block=10):
    """Seal what can be sealed now; the sealed rows."""
    out = []
    sealed = rotation.rotated(source(spark, folder), SCHEMA, "partition", "offset", limit, age, block)
    q = sealed.writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", str(checkpoint)).trigger(**NOW).start()
    settle(q, folder)
    return out


def folded(rows, limit=700, block=10):
    """stream, seq, start, end, offset, line of the files that the batch fold cuts; the last one is still open."""
    out = []
    for p in sorted({r[0] for r in rows}, key=str):
        mine = sorted((r[1], f'{r[2]},"' + r[3].replace('"', '""') + '"') for r in rows if r[0] == p)
        blocks = {}
        for o, line in mine:
            blocks.setdefault(o // block, []).append((o, line))
        whole = [b for b in blocks.values()]
        numbers = cut_files(pd.DataFrame({"n_rows": [len(b) for b in whole], "n_bytes": [sum(len(x.encode()) + 1 for _, x in b) for b in whole]}), limit)
        files = {}
        for n, b in zip(numbers, whole, strict=True):
            files.setdefault(n, []).extend(b)
        name = "null" if p is None else f"p{p}"
        out += [(name, n, f[0][0], f[-1][0], o, line) for n, f in files.items() for o, line in f]
    return out


def closed(rows, files):
    """Without each stream's last file, which is open as long as nothing seals it."""
    last = {}
    for f in files:
        last[f[0]] = max(last.get(f[0], 0), f[1])
    return sorted(f for f in files if f[1] < last[f[0]])


def shown(sealed):
    return sorted((r[0], r[1], r[2], r[3], r[5], r[7]) for r in sealed)


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_files_are_those_of_the_fold_however_batches_are_cut(spark, tmp_path, parts):
    rows = rows_of(205, (0, 1, None))
    feed(spark, tmp_path / "in", rows, parts)
    sealed = run(spark, tmp_path / "in", tmp_path / "check")
    want = closed(rows, folded(rows))
    # The last block of a stream may have filled its file, which then is sealed already.
    assert [r for r in shown(sealed) if r in set(want)] == want and {r[4] for r in sealed} == {"size"}
    assert set(shown(sealed)) <= set(folded(rows)) and len(want) > 300


def test_a_restart_goes_on_inside_the_open_file(spark, tmp_path):
    rows = rows_of(160)
    feed(spark, tmp_path / "in", rows[:150], 2)
    first = run(spark, tmp_path / "in", tmp_path / "check")
    # What comes again was taken already.
    feed(spark, tmp_path / "in", rows[100:], 3)
    second = run(spark, tmp_path / "in", tmp_path / "check")
    assert first and second and not {(r[0], r[5]) for r in first} & {(r[0], r[5]) for r in second}
    got = shown(first + second)
    assert set(got) <= set(folded(rows)) and set(got) >= set(closed(rows, folded(rows)))


def test_age_seals_without_input(spark, tmp_path):
    rows = rows_of(7)
    feed(spark, tmp_path / "in", rows, 1)
    out = []
    sealed = rotation.rotated(source(spark, tmp_path / "in"), SCHEMA, "partition", "offset", 1 << 30, 2.0)
    q = sealed.writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
    deadline = time.time() + 60
    while len(out) < 14 and time.time() < deadline:
        time.sleep(0.2)
    q.stop()
    assert shown(out) == sorted(folded(rows, 1 << 30, 1)) and {r[4] for r in out} == {"age"}


def test_settings_are_checked(spark, tmp_path):
    feed(spark, tmp_path / "in", rows_of(1), 1)
    with pytest.raises(ConfigError):
        rotation.rotated(source(spark, tmp_path / "in"), SCHEMA, "partition", "offset", 0, 1.0)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ConfigError, match="providerClass"):
        rotation.rotated(source(spark, tmp_path / "in"), SCHEMA, "partition", "offset", 10, 1.0)


def staged(spark, tmp_path, upsert=True):
    store = Store(spark, str(tmp_path / "lake"))
    return store, StagedStream(store, "staging/t", SCHEMA if upsert else TableSchema(COLUMNS, (), 7, 8), EPOCH, upsert)


def go(spark, tmp_path, sink, limit=700):
    sealed = rotation.rotated(source(spark, tmp_path / "in"), sink.schema, "partition", "offset", limit, 3600.0, 10)
    settle(sink.start(sealed, str(tmp_path / "check"), NOW), tmp_path / "in")


def wanted(rows, upsert):
    """Name, rows of each closed file."""
    files = {}
    for s, n, a, b, o, line in folded(rows):
        files.setdefault((s, n, a, b), []).append((o, line))
    out = {}
    for (s, n, a, b), lines in files.items():
        if upsert:
            lines = sorted({line.split(",")[0]: (o, line) for o, line in lines}.values())
        out[f"{s}/{EPOCH:013d}-{n:07d}-o{a}-{b}.csv.gz"] = '"id","name"\n' + "".join(line + "\n" for _, line in lines)
    return out


def on_disk(tmp_path):
    root = tmp_path / "lake/staging/t"
    return {str(f.relative_to(root)): gzip.open(f).read().decode() for f in root.rglob("*.csv.gz") if not f.name.startswith(".") and "_attempts" not in str(f)}


@pytest.mark.parametrize("upsert", [True, False])
def test_files_and_ledger_agree(spark, tmp_path, upsert):
    rows = rows_of(205)
    feed(spark, tmp_path / "in", rows, 3)
    store, sink = staged(spark, tmp_path, upsert)
    go(spark, tmp_path, sink)
    files, want = on_disk(tmp_path), wanted(rows, upsert)
    assert files and all(want[k] == v for k, v in files.items())
    book = sink.ledger(spark).collect()
    assert sorted(r.object for r in book) == sorted(files) and len({r.identifier for r in book}) == len(book)
    back = reader.read_staged(spark, store.uri("staging/t/p*"), COLUMNS)
    assert back.count() == sum(r.n_rows for r in book)


#: Where the driver dies: before anything is written, with the attempt written, at the moves, before the page.
KILLS = ["prepare", "messages", "record", "move", "second move", "page"]


@pytest.mark.parametrize("where", KILLS)
def test_a_kill_anywhere_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, where):
    rows = rows_of(205)
    feed(spark, tmp_path / "in", rows, 2)
    store, sink = staged(spark, tmp_path)
    left = [1 if where == "second move" else 0]

    def dies(*_):
        if left[0]:
            left[0] -= 1
            return real(*_)
        raise KeyError("killed")

    if where == "prepare":
        monkeypatch.setattr(sink.sink, "prepare", dies)
    elif where == "messages":
        # The attempt stays behind as a dead driver leaves it.
        monkeypatch.setattr(sink.sink, "_messages", dies)
        monkeypatch.setattr(sink.sink, "abort", lambda _: None)
    elif where == "record":
        monkeypatch.setattr(sink.sink, "commit", dies)
    elif where in ("move", "second move"):
        real = sink.store.move
        monkeypatch.setattr(sink.sink.store, "move", dies)
    else:
        monkeypatch.setattr(sink, "_enter", dies)
    with pytest.raises(Exception, match="killed"):
        go(spark, tmp_path, sink)
    assert sink.ledger(spark).count() == 0
    _, again = staged(spark, tmp_path)
    go(spark, tmp_path, again)
    files, want = on_disk(tmp_path), wanted(rows, True)
    assert {k.partition("/")[0] for k in files} == {"p0", "p1"} and all(want[k] == v for k, v in files.items())
    assert {k for k, v in want.items()} - set(files) <= {max(k for k in want if k.startswith(p)) for p in ("p0", "p1")}
    book = again.ledger(spark).collect()
    assert sorted(r.object for r in book) == sorted(files)
    assert not list((tmp_path / "lake/staging/t/_attempts").iterdir())


def test_a_page_that_is_there_is_not_written_again(spark, tmp_path, monkeypatch):
    rows = [("p0", 0, 0, 1, "size", o, str(o), f'{o},"a"') for o in range(2)]
    _, sink = staged(spark, tmp_path)
    frame = spark.createDataFrame(rows, rotation.SEALED)
    sink.write(frame, 4)
    monkeypatch.setattr(sink.sink, "prepare", lambda *_: pytest.fail("written again"))
    sink.write(frame, 4)
    assert sink.ledger(spark).count() == 1 and csv.header_text(["id"]) == '"id"'
