"""Order, gaps, the gate and the attempt log against slow versions that go through the rows one by one."""

import random

import pytest
from pyspark.sql import functions as F

from weirline.config import backoff
from weirline.operators import attempts, ledger


def breaks(files):
    """The checks of each group's files, one after the other."""
    out, last = [], {}
    for g, epoch, seq, start, end in files:
        if g in last:
            pe, ps, pend = last[g]
            if not (epoch == pe and seq == ps + 1 or epoch > pe and seq == 0):
                lost = (ps + 1, seq - 1) if epoch == pe and seq > ps + 1 else (0, seq - 1) if epoch > pe else (None, None)
                out.append((g, epoch, seq, *lost, *((pend + 1, start - 1) if start > pend + 1 else (None, None))))
        last[g] = epoch, seq, end
    return sorted(out, key=repr)


def test_breaks_name_what_is_missing(spark):
    files = [("a", 5, 7, 100, 110), ("a", 5, 9, 130, 140), ("a", 5, 8, 111, 129), ("a", 5, 8, 111, 129), ("a", 6, 0, 141, 150), ("a", 7, 3, 200, 210), ("a", 6, 1, 151, 160), ("b", 1, 4, 10, 20), ("b", 1, 5, 40, 50), ("c", 1, 0, 5, 6)]
    frame = spark.createDataFrame([(*f, i) for i, f in enumerate(files)], "serial_group string, epoch_ms long, seq long, start_offset long, end_offset long, arrival int")
    got = ledger.order_breaks(frame).select("serial_group", "epoch_ms", "seq", "missing_from", "missing_to", "missing_start", "missing_end")
    assert sorted(map(tuple, got.collect()), key=repr) == breaks(files)
    assert ("a", 5, 9, 8, 8, 111, 129) in breaks(files) and ("a", 7, 3, 0, 2, 151, 199) in breaks(files)


@pytest.mark.parametrize("seed", range(4))
def test_holes_depend_on_what_is_there_not_on_its_order(spark, seed):
    rng = random.Random(seed)
    files, want = [], []
    for g in ("a", "b", "c"):
        whole = [(g, e, s, 100 * (40 * e + s), 100 * (40 * e + s) + 99) for e in range(3) for s in range(rng.randint(1, 40))]
        kept = [f for f in whole if rng.random() < 0.6]
        end = None
        for prev, f in zip([None, *kept], kept, strict=False):
            if prev is not None:
                start = prev[2] + 1 if prev[1] == f[1] else 0
                if f[2] > start:
                    want.append((g, f[1], start, f[2] - 1, *((end + 1, f[3] - 1) if f[3] > end + 1 else (None, None))))
            end = f[4] if end is None else max(end, f[4])
        files += kept + rng.sample(kept, len(kept) // 3)
    rng.shuffle(files)
    frame = spark.createDataFrame(files, "serial_group string, epoch_ms long, seq long, start_offset long, end_offset long").repartition(3)
    assert sorted(map(tuple, ledger.missing_ranges(frame).collect())) == sorted(want)
    assert ledger.missing_ranges(frame.limit(0)).count() == 0 == ledger.missing_ranges(frame.limit(1)).count()


def judge(jobs, book):
    """One job after the other, each accepted one booked."""
    done = [j for j in book if j[3] in ledger.TERMINAL]
    known, places = {j[2] for j in book}, {j[:2] for j in book if j[3] not in ledger.TERMINAL}
    marks = {g: max(j[1] for j in done if j[0] == g) for g in {j[0] for j in done}}
    out = []
    for g, s, ident, at in sorted(jobs, key=lambda j: j[3]):
        verdict = "replay" if s <= marks.get(g, -1) or ident in known else "violation" if (g, s) in places else "accept"
        if verdict == "accept":
            known.add(ident)
            places.add((g, s))
        out.append((g, s, ident, at, verdict))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_jobs_of_one_batch_are_judged_in_order(spark, seed):
    rng = random.Random(seed)
    book = [(g, s, f"{g}:{s}", "FINISH" if s < 3 else "READY") for g in "ab" for s in range(6)]
    # An identifier names its place.
    jobs = [(g := rng.choice("abc"), s := rng.randint(0, 9), f"{g}:{s}" + rng.choice(["", "", "x", "y"]), at) for at in range(150)]
    rng.shuffle(jobs)
    frame = spark.createDataFrame(jobs, "serial_group string, serial_seq long, identifier string, arrival int").repartition(4)
    held = spark.createDataFrame(book, "serial_group string, serial_seq long, identifier string, status string")
    got = sorted(map(tuple, ledger.gate(frame, held, "arrival").select("serial_group", "serial_seq", "identifier", "arrival", "verdict").collect()))
    assert got == judge(jobs, book) and {r[4] for r in got} == {"accept", "replay", "violation"}


def test_an_identifier_of_two_places_is_a_violation_and_holds_none(spark):
    jobs = [("a", 1, "A", 0), ("a", 2, "A", 1), ("a", 2, "B", 2), ("a", 2, "B", 3), ("a", 2, "C", 4), ("a", 1, "A", 5)]
    frame = spark.createDataFrame(jobs, "serial_group string, serial_seq long, identifier string, arrival int")
    none = spark.createDataFrame([], "serial_group string, serial_seq long, identifier string, status string")
    got = {r.arrival: r.verdict for r in ledger.gate(frame, none, "arrival").collect()}
    assert got == {0: "accept", 1: "violation", 2: "accept", 3: "replay", 4: "violation", 5: "replay"}


def run_job(events, limit):
    """The state machine, an event at a time."""
    status, tries, reason, last = "READY", 0, None, None
    for at, event in events:
        if status in ("FINISH", "SKIPPED"):
            break
        if event == "retry":
            status, tries, reason, last = "READY", 0, None, None
        elif event == "skip":
            status, reason = ("SKIPPED", None) if status == "FAIL" else (status, reason)
        elif status != "FAIL":
            tries, last = tries + 1, at
            if event == "ok":
                status = "FINISH"
            elif event == "permanent":
                status, reason = "FAIL", "permanent"
            elif limit is not None and tries > limit:
                status, reason = "FAIL", "retries"
            else:
                status = "RETRY"
    if status != "RETRY":
        return status, tries, reason, None, None
    due = last + int(1000 * backoff(tries))
    return status, tries, reason, due, None if limit is None else last + int(1000 * sum(backoff(k) for k in range(tries, limit + 1)))


def test_logs_fold_to_states(spark):
    rng, rows, want = random.Random(1), [], {}
    for j in range(400):
        limit = rng.choice([0, 1, 2, 7, 15, None])
        n = rng.randint(1, 12)
        kinds = rng.choices(["transient", "permanent", "ok", "retry", "skip"], [rng.choice([3, 30]), 1, 1, 2, 2], k=n)
        events = [(1000 * i, k) for i, k in enumerate(kinds)]
        rows += [(f"j{j}", limit, *e) for e in events]
        want[f"j{j}"] = run_job(events, limit)
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "identifier string, retry_max int, at_ms long, event string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in attempts.job_states(frame).collect()}
    assert got == want and {w[0] for w in want.values()} == {"READY", "RETRY", "FINISH", "FAIL", "SKIPPED"}
    assert attempts.job_states(frame.limit(0)).collect() == []


def test_pauses_are_those_of_the_writer(spark):
    rows = spark.range(1, 40).select(F.col("id"), attempts.pause(F.col("id")).alias("p"), attempts.pauses(F.col("id")).alias("s")).collect()
    assert all(r.p == backoff(r.id) and r.s == sum(backoff(k) for k in range(1, r.id + 1)) for r in rows)
