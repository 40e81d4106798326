"""A writer: takes batches with offset ranges, seals them into staged files, announces and loads these in order.

What Spark does for it: rendering and last-value by key are DataFrame plans; a failed task is run again
and gives the same files. What the driver holds: the names of batches not yet staged, and small JSON objects
(state, jobs, lease, manifests). File names come from the epoch and a running number, or, in a stream, from
the micro-batch, so a replay gives the same names.

Nothing that was taken is given up: a sealed file keeps its batches, and its name, until it is staged, however
often that fails; a staged file is loaded, or stops its group. Files of a group are loaded strictly in order: behind
one that failed for good nothing is loaded, the watermark stays below it, and the next opening announces it again.
"""

from __future__ import annotations

import gzip
import json
import logging
import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Compression, Config, Mode, backoff
from ..errors import ConfigError, DatabaseError, EngineError, InputError, RotationFailed, SchemaError, SerialContractViolation, StagedFileLost, StagingOrderViolation, StagingStalled, StorageError, WriterClosed, WriterFenced, worst
from ..functions import naming
from ..functions.csv_dialect import header_text
from ..operators.tables import last_wins
from ..sources.sink import StagingSink
from ..sources.staging import list_staged, read_files
from ..sources.store import Store
from ..types import TableSchema, same_schema
from .lease import Lease
from .target import Target

log = logging.getLogger("weirline")

#: What a job's row says besides its own values (fixed values): added by, version, kinds of source and target, priority.
JOB = {"add_by": 4, "version": 1, "source_type": 1, "target_type": 3, "priority": 1, "msg": None, "source_detail": None}
#: A job's status by name (2: ready; the rest are this engine's own).
STATUS = {"READY": 2, "FINISH": 3, "FAIL": 4, "SKIPPED": 5}


@dataclass
class RecoveryPlan:
    next_offset: int | None
    backfill: list[dict]
    top: tuple[int, int] | None


@dataclass
class Lag:
    lag_seconds: int
    lag_files: int
    buffered_age_seconds: float
    sampled_at: float


@dataclass
class Progress:
    """The last durable offset; of the files that fail the first one, how often it failed, and why."""

    staged_offset: int | None = None
    failing: str | None = None
    attempts: int = 0
    reason: str | None = None


def plan_recovery(staged: list[dict], watermark: int | None, resume: int | None = None) -> RecoveryPlan:
    """Resume after the highest end of all files and of the saved state; announce what is above the watermark."""
    staged = sorted(staged, key=lambda f: (f["epoch_ms"], f["seq"]))
    nexts = [f["end_offset"] + 1 for f in staged] + ([resume + 1] if resume is not None else [])
    back = [f for f in staged if watermark is None or naming.encode(f["epoch_ms"], f["seq"]) > watermark]
    return RecoveryPlan(max(nexts, default=None), back, (staged[-1]["epoch_ms"], staged[-1]["seq"]) if staged else None)


def check_order(previous: dict | None, following: dict) -> None:
    if previous is None:
        return
    a, b = (previous["epoch_ms"], previous["seq"]), (following["epoch_ms"], following["seq"])
    if b == (a[0], a[1] + 1) or b[0] > a[0] and b[1] == 0:
        return
    raise StagingOrderViolation(f"after {a} comes {b}: offsets {previous['end_offset'] + 1} to {following['start_offset'] - 1} may be missing")


def file_name(f: dict) -> str:
    return f"{f['epoch_ms']:013d}-{f['seq']:07d}-o{f['start_offset']}-{f['end_offset']}.csv" + (".gz" if f["compressed"] else "")


@dataclass
class _Batch:
    rows: DataFrame
    start: int
    end: int
    n_rows: int
    taken_at: float


@dataclass
class _State:
    closed: bool = False
    errors: list[EngineError] = field(default_factory=list)
    alarmed: int = -1


class Engine:
    """Opens tables under one root with one configuration."""

    def __init__(self, spark: SparkSession, config: Config, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.spark, self.config, self.clock, self.sleep = spark, config.check(), clock, sleep
        self.store = Store(spark, config.root)
        self.refreshed_at = clock()
        if config.credentials:
            self._use(config.credentials)

    def _use(self, credentials) -> None:
        credentials.check()
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        conf.set("fs.s3a.access.key", credentials.key_id)
        conf.set("fs.s3a.secret.key", credentials.secret)

    def refresh_credentials(self) -> bool:
        """Take new credentials, if the configuration says where from; nothing but these can change."""
        self.refreshed_at = self.clock()
        if self.config.refresh is None:
            return False
        self.config.credentials = self.config.refresh()
        self._use(self.config.credentials)
        return True

    def open_table(self, name: str, schema: TableSchema, writer_id: str, mode: Mode | None = None) -> tuple[TableWriter, RecoveryPlan]:
        """The handshake: validate, lease, state, watermark, listing, plan, epoch, state saved, backfill loaded."""
        writer = TableWriter(self, name, schema, writer_id, mode or self.config.mode)
        try:
            plan = writer._recover()
            writer._start()
            return writer, plan
        except BaseException:
            writer._stop()
            writer.lease.release()
            raise


    def forget_writer(self, schema: TableSchema, writer_id: str) -> bool:
        """Delete a writer's saved state, for an operator who gives its identity up or has it start from its files alone; whether there
        was one. Only while no writer holds the lease; staged files, jobs and the table stay."""
        naming.check_segment(writer_id, writer=True)
        c = self.config
        meta = f"staging/{c.cluster_id}/{schema.db_id}/{schema.rel_id}/{writer_id}/_meta"
        lease = Lease(self.store, f"{meta}/lease.json", c.lock_lease_timeout, self.clock, c.lock_settle, c.lock_wait, sleep=self.sleep)
        lease.acquire()
        try:
            there = self.store.exists(f"{meta}/state.json")
            return there and self.store.delete(f"{meta}/state.json")
        finally:
            lease.release()


class TableWriter:
    def __init__(self, engine: Engine, table: str, schema: TableSchema, writer_id: str, mode: Mode):
        naming.check_segment(writer_id, writer=True)
        naming.check_segment(engine.config.cluster_id)
        schema.check(upsert=mode is Mode.UPSERT)
        self.engine, self.config, self.store = engine, engine.config, engine.store
        self.table, self.schema, self.writer_id, self.mode = table, schema, writer_id, mode
        c = self.config
        self.serial_group = f"{schema.db_id}:{schema.rel_id}:{writer_id}"
        self.folder = f"staging/{c.cluster_id}/{schema.db_id}/{schema.rel_id}/{writer_id}"
        self._state_key = f"{self.folder}/_meta/state.json"
        self.sink = StagingSink(self.store, self.folder)
        self.target = Target(engine.spark, f"{self.store.root}/tables/{schema.db_id}/{schema.rel_id}", schema.columns, schema.key if mode is Mode.UPSERT else (), c.buckets)
        self.lease = Lease(self.store, f"{self.folder}/_meta/lease.json", c.lock_lease_timeout, engine.clock, c.lock_settle, c.lock_wait, sleep=engine.sleep)
        #: Batches not yet sealed; sealed files, not yet staged, with theirs; staged files, not yet loaded.
        self._buffer: list[_Batch] = []
        self._sealed: deque[tuple[dict, list[_Batch]]] = deque()
        self._staged: deque[dict] = deque()
        self._status, self.progress = _State(), Progress()
        self._row_bytes = 128.0
        self._lag: Lag | None = None
        self.staged_offset: int | None = None
        self._top: int | None = None
        self._last_file: dict | None = None
        self._resume: int | None = None
        self._lock, self._over, self._thread = threading.RLock(), threading.Event(), None
        now = engine.clock()
        self._due = {"heartbeat": now, "lag": now, "state": now, "gc": now}
        self.lease.acquire()

    # -- opening

    def _recover(self) -> RecoveryPlan:
        state = self.store.get_json(self._state_key) or {}
        for name, mine in (("cluster_id", self.config.cluster_id), ("writer_id", self.writer_id), ("db_id", self.schema.db_id)):
            if name in state and state[name] != mine:
                raise ConfigError(f"the saved {name} is {state[name]!r}, not {mine!r}")
        if state.get("table", self.table) != self.table:
            log.info("table %s was renamed to %s", state["table"], self.table)
        self._resume = state.get("resume_offset")
        watermark = self.target.applied(self.serial_group)
        # What a writer before this one committed and didn't move; the lease says that there is none beside it.
        self.sink.recover()
        staged, odd = list_staged(self.store, self.folder)
        if odd:
            log.warning("%d objects are no staged files", len(odd))
        plan = plan_recovery(staged, watermark if watermark >= 0 else None, state.get("resume_offset"))
        largest = max([naming.decode(max(watermark, 0))[0], state.get("max_epoch", 0), *(f["epoch_ms"] for f in staged)])
        now = int(self.engine.clock() * 1000)
        self.epoch, self.seq = (largest + 1 if now <= largest else now), 0
        naming.encode(self.epoch, 0)
        self._save_state(state.get("resume_offset"))
        if plan.next_offset is not None:
            self.staged_offset = self._top = plan.next_offset - 1
        self._staged.extend(plan.backfill)
        self._load_staged()
        return plan

    def _save_state(self, resume: int | None) -> None:
        """resume only advances: the state may know of files that clean-up deleted."""
        self.lease.verify()
        self._resume = resume = max((r for r in (resume, self._resume) if r is not None), default=None)
        self.store.put(self._state_key, json.dumps({"cluster_id": self.config.cluster_id, "db_id": self.schema.db_id, "writer_id": self.writer_id, "table": self.table, "max_epoch": self.epoch, "resume_offset": resume}))

    # -- health

    def _healthy(self) -> None:
        if self._status.closed:
            raise WriterClosed("the writer is closed")
        if (e := self.fatal_error()) is not None:
            raise e

    def fatal_error(self) -> EngineError | None:
        return worst(self._status.errors)

    def _fatal(self, e: EngineError) -> EngineError:
        """Stop the writer; one alarm, and another only for a worse reason."""
        self._status.errors.append(e)
        if e.priority > self._status.alarmed:
            self._status.alarmed = e.priority
            log.critical("writer %s of %s stopped: %s: %s", self.writer_id, self.table, type(e).__name__, e)
        return e

    # -- writing

    def append(self, rows: DataFrame, start: int, end: int, n_rows: int | None = None) -> None:
        """Take a batch of rows in order (a column `_ord`, if there is one, is that order). The range is inclusive, may leave
        gaps to the one before, and may not go back. An error says that the batch wasn't taken, but for one in the flush that
        a full buffer brings about: then `append` was refused only if `fatal_error` says why."""
        with self._lock:
            self._healthy()
            if start < 0 or end < start:
                raise ConfigError(f"{start} to {end} is no offset range")
            data = rows.drop("_ord") if "_ord" in rows.columns else rows
            if not same_schema(data.schema, self.schema.columns):
                raise SchemaError(f"{data.schema.simpleString()} isn't {self.schema.columns.simpleString()}")
            if self._top is not None and start <= self._top:
                raise ConfigError(f"offset {start} was passed: {self._top} was taken already")
            # Backpressure: as long as rotation_queue_depth files wait to be staged nothing more is taken.
            if len(self._sealed) >= self.config.rotation_queue_depth:
                self._drain()
            n = rows.count() if n_rows is None else n_rows
            self._buffer.append(_Batch(rows, start, end, n, self.engine.clock()))
            self._top = end
            if self._ripe():
                self._seal()
                try:
                    self._drain()
                except StagingStalled as e:
                    log.error("%s", e)  # the batch was taken, and is tried again with the next call

    def _ripe(self) -> bool:
        if not self._buffer:
            return False
        size = sum(b.n_rows for b in self._buffer) * self._row_bytes
        return size >= self.config.rotate_size_bytes or self.engine.clock() - self._buffer[0].taken_at >= self.config.rotate_interval_max

    def flush(self) -> int | None:
        """Seal, stage, announce and load all that was taken; the last offset that is durable."""
        with self._lock:
            self._healthy()
            self._seal()
            self._drain()
            return self.staged_offset

    def _seal(self) -> None:
        """Cut the whole buffer off as a file; its number is spent, whatever becomes of it."""
        if not self._buffer:
            return
        if self.seq > naming.SEQ_MAX:
            self.epoch, self.seq = self.epoch + 1, 0
            self._save_state(self.staged_offset)
        held = {"epoch_ms": self.epoch, "seq": self.seq, "start_offset": self._buffer[0].start, "end_offset": max(b.end for b in self._buffer), "compressed": self.config.compression is Compression.GZIP}
        self._sealed.append((held, self._buffer))
        self._buffer, self.seq = [], self.seq + 1

    def _drain(self) -> None:
        """Stage what is sealed, in order, and load what is staged, in order."""
        while self._sealed:
            held, batches = self._sealed[0]
            self._stage_with_retries(held, batches)
            self._sealed.popleft()
            self._staged.append(held)
            self._load_staged()
        self._load_staged()

    def _stage_with_retries(self, held: dict, batches: list[_Batch]) -> None:
        name, attempt = file_name(held), 0
        while True:
            try:
                self._stage(held, batches)
            except (WriterFenced, StagingOrderViolation) as e:
                raise self._fatal(e) from None
            except InputError as e:
                raise self._fatal(RotationFailed(f"{name}: {e}")) from e
            except Exception as e:
                attempt += 1
                # The slot names the first file that fails; a later one can't be reached before it.
                self.progress.failing, self.progress.attempts, self.progress.reason = name, self.progress.attempts + 1, str(e)[:500]
                if attempt >= self.config.staging_error_after_attempts:
                    raise StagingStalled(f"{name} could not be staged {self.progress.attempts} times; it is kept: {e}") from e
                if "AccessDenied" in str(e) or "403" in str(e):
                    self.engine.refresh_credentials()
                self.engine.sleep(backoff(attempt))
            else:
                if self.progress.failing == name:
                    self.progress = Progress()
                self.progress.staged_offset = self.staged_offset
                return

    def _stage(self, held: dict, batches: list[_Batch]) -> None:
        check_order(self._last_file, held)
        self.lease.verify()
        names = self.schema.columns.names
        whole = None
        for k, b in enumerate(batches):
            ord_ = F.col("_ord").cast("long") if "_ord" in b.rows.columns else F.monotonically_increasing_id()
            part = b.rows.select(*names, F.lit(k).alias("_batch"), ord_.alias("_row"))
            whole = part if whole is None else whole.unionByName(part)
        if self.mode is Mode.UPSERT:
            whole = last_wins(whole, list(self.schema.key), F.struct("_batch", "_row"))
        key = f"{self.folder}/{file_name(held)}"
        whole = whole.withColumn("_name", F.lit(file_name(held)))
        made = self.sink.write(whole, names, "_name", ["_batch", "_row"], self.config.delimiter, held["compressed"])
        if made and made[0].n_rows:
            self._row_bytes = made[0].n_bytes / made[0].n_rows
        else:
            # No rows: the header alone, so that a file that isn't there is always one that was lost.
            head = (header_text(names, self.config.delimiter) + "\n").encode()
            self.store.put(key, gzip.compress(head, 6, mtime=0) if held["compressed"] else head)
        self.lease.verify()
        self._last_file = held
        self.staged_offset = max(held["end_offset"], -1 if self.staged_offset is None else self.staged_offset)

    # -- loading

    def _load_staged(self) -> None:
        """Load the staged files, the first one first. A store that doesn't answer is asked again, and the file stays the
        first; a file that can't be loaded, a broken contract or a lost lease stop the writer."""
        attempt = 0
        while self._staged:
            f = self._staged[0]
            name = file_name(f)
            try:
                self._announce(f)
            except (StorageError, Py4JJavaError) as e:
                attempt += 1
                self.progress.failing, self.progress.attempts, self.progress.reason = name, self.progress.attempts + 1, str(e)[:500]
                if attempt >= self.config.staging_error_after_attempts:
                    raise StagingStalled(f"{name} could not be announced {self.progress.attempts} times; it is kept: {e}") from e
                self.engine.sleep(backoff(attempt))
                continue
            except EngineError as e:
                self.progress.failing, self.progress.attempts, self.progress.reason = name, self.progress.attempts + 1, str(e)[:500]
                if e not in self._status.errors:
                    self._fatal(e)
                raise
            attempt = 0
            if self.progress.failing == name:
                self.progress = Progress(self.progress.staged_offset)
            self._staged.popleft()

    def _announce(self, f: dict) -> None:
        """Through the gate, into the ledger, into the target; a file known already changes nothing."""
        self.lease.verify()
        serial = naming.encode(f["epoch_ms"], f["seq"])
        identifier = f"{self.serial_group}:{f['epoch_ms']}:{f['seq']}"
        if serial <= self.target.applied(self.serial_group):
            return
        job = self.store.get_json(self._job_key(serial))
        if job and (job["identifier"], job["object"]) != (identifier, file_name(f)):
            raise SerialContractViolation(f"{serial} was announced as {job['identifier']}, {job['object']}")
        self._book(serial, identifier, f, "READY", 0)
        attempts = 0
        while True:
            try:
                self._load(f, serial)
                break
            except WriterFenced:
                raise
            except Exception as e:
                attempts += 1
                if isinstance(e, StagedFileLost) or self.config.retry_max is not None and attempts > self.config.retry_max:
                    self._book(serial, identifier, f, "FAIL", attempts)
                    raise DatabaseError(f"{file_name(f)} could not be loaded {attempts} times: {e}") from e
                self.engine.sleep(backoff(attempts))
        self._book(serial, identifier, f, "FINISH", attempts)

    def _job_key(self, serial: int) -> str:
        return f"{self.folder}/_meta/jobs/{serial:020d}.json"

    def _book(self, serial: int, identifier: str, f: dict, status: str, attempts: int) -> None:
        """A job's row, an object of its own."""
        c = self.config
        retry = -1 if c.retry_max is None else c.retry_max
        options = f'format=csv,header=true,delimiter="{c.delimiter}"' + ",mode=upsert" * (self.mode is Mode.UPSERT)
        self.store.put(self._job_key(serial), json.dumps(JOB | {"identifier": identifier, "serial_group": self.serial_group, "serial_seq": serial, "db_id": self.schema.db_id, "rel_id": self.schema.rel_id, "object": file_name(f), "options": options, "end_offset": f["end_offset"], "retry_max": retry, "status": STATUS[status], "status_name": status, "attempts": attempts}))

    def jobs(self) -> list[dict]:
        """The rows of this writer's jobs, in order."""
        names = [n for n, _ in self.store.list(f"{self.folder}/_meta/jobs")]
        return [j for n in names if (j := self.store.get_json(f"{self.folder}/_meta/jobs/{n}"))]

    def confirmed(self) -> int | None:
        """The end offset of the last file that is loaded."""
        mark = self.target.applied(self.serial_group)
        return (self.store.get_json(self._job_key(mark)) or {}).get("end_offset") if mark >= 0 else None

    def _load(self, f: dict, serial: int) -> None:
        key = f"{self.folder}/{file_name(f)}"
        if not self.store.exists(key):
            raise StagedFileLost(f"{key} was staged and is gone")
        rows = read_files(self.engine.spark, [self.store.uri(key)], self.schema.columns, self.config.delimiter).select(*self.schema.columns.names)
        put = self.target.upsert if self.mode is Mode.UPSERT else self.target.append
        self.lease.verify()
        put(rows, {self.serial_group: serial})

    # -- chores

    def _start(self) -> None:
        if not self.config.ticker:
            return
        pause = max(min(self.config.rotate_interval_max / 2, self.config.lock_heartbeat_interval), 0.2)

        def run() -> None:
            while not self._over.wait(pause):
                try:
                    self.tick()
                except Exception as e:  # what stops the writer is kept in its status
                    log.error("%s: %s", type(e).__name__, e)

        self._thread = threading.Thread(target=run, name=f"weirline-{self.writer_id}", daemon=True)
        self._thread.start()

    def _stop(self) -> None:
        self._over.set()
        if self._thread is not None and self._thread is not threading.current_thread():
            self._thread.join()

    def _is_due(self, chore: str, interval: float) -> bool:
        now = self.engine.clock()
        if now - self._due[chore] < interval:
            return False
        self._due[chore] = now
        return True

    def tick(self) -> None:
        """What is due: the lease's heartbeat; sealing by age, also where no batch comes; lag, state and clean-up; credentials."""
        c = self.config
        if self._status.closed or self.fatal_error() is not None:
            return
        # Not under the lock: a long load must not let the lease grow old.
        if self._is_due("heartbeat", c.lock_heartbeat_interval):
            try:
                self.lease.heartbeat()
            except WriterFenced as e:
                raise self._fatal(e) from None
        if self.engine.clock() - self.engine.refreshed_at >= c.staging_refresh_interval:
            self.engine.refresh_credentials()
        if not self._lock.acquire(blocking=False):
            return
        try:
            if self._status.closed:
                return
            if self._ripe():
                self._seal()
            if self._sealed:
                self._drain()
            if self._is_due("lag", c.lag_sample_interval):
                self.lag()
            if self._is_due("state", c.state_heartbeat_interval):
                self._save_state(self.confirmed())
            if self._is_due("gc", c.gc_interval):
                self.collect_garbage()
        finally:
            self._lock.release()

    def lag(self) -> Lag:
        """Files above the watermark and the age of the oldest, and of what is not yet staged."""
        staged, _ = list_staged(self.store, self.folder)
        mark, now = self.target.applied(self.serial_group), self.engine.clock()
        open_ = [f for f in staged if naming.encode(f["epoch_ms"], f["seq"]) > mark]
        oldest = min((f["epoch_ms"] for f in open_), default=None)
        seconds = max(0, int(now * 1000) - oldest) // 1000 if oldest is not None else 0
        waiting = [*self._buffer, *(b for _, batches in self._sealed for b in batches)]
        self._lag = Lag(seconds, len(open_), max((now - b.taken_at for b in waiting), default=0.0), now)
        return self._lag

    def collect_garbage(self) -> list[str]:
        """Delete staged files, and their jobs, that nothing needs any more; stops at the first that can't be deleted."""
        mark = self.target.applied(self.serial_group)
        staged, _ = list_staged(self.store, self.folder)
        now = int(self.engine.clock() * 1000)
        self.target.vacuum(now)
        if mark < 0 or len(staged) <= self.config.gc_retain_min_files:
            return []
        serial = lambda f: naming.encode(f["epoch_ms"], f["seq"])
        able = [f for f in staged[:-1] if serial(f) <= mark and now - f["epoch_ms"] > self.config.gc_retain_days * 86_400_000]
        gone = []
        for f in able[: len(staged) - self.config.gc_retain_min_files]:
            if not self.store.delete(f"{self.folder}/{f['name']}"):
                break
            gone.append(f["name"])
            if serial(f) != mark:
                self.store.delete(self._job_key(serial(f)))
        return gone

    def close(self) -> None:
        """Flush, save the state, end the chores, release the lease."""
        with self._lock:
            if self._status.closed:
                return
            try:
                self.flush()
                self._save_state(self.staged_offset)
            finally:
                self._status.closed = True
                self._over.set()
                if self.fatal_error() is not None:
                    self.lease.release()
        self._stop()
        self.lease.release()

    def abandon(self) -> None:
        """Give the writer up as it is: what isn't staged is for the source to send again."""
        self._status.closed = True
        self._stop()
        self.lease.release()

    def __enter__(self) -> TableWriter:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.close()
        else:
            self.abandon()
