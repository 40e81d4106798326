"""Lag without listing a folder: what was sealed, told by the sink, against what was taken, told by the query's own progress.

The sink reports each file that becomes durable; the consumer's stream carries observed metrics, and its progress the offsets up to
which it is done. A listener brings both together: of each stream the files that wait, the age of the oldest, and the
rows that went through. Files are forgotten as soon as they are taken, so the board holds what waits and nothing else.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: The name of the observed metrics.
METRICS = "weirline_taken"
SCHEMA = "stream string, lag_files long, lag_seconds long, taken_epoch_ms long, taken_seq long"
PROGRESS = "query string, batch_id long, at string, n_rows long, oldest_epoch_ms long, newest_epoch_ms long"


def observed(stream: DataFrame) -> DataFrame:
    """A stream of staged files (see sources.staged_source) that reports what it takes."""
    return stream.observe(METRICS, F.count("*").alias("n_rows"), F.min("_epoch").alias("oldest_epoch_ms"), F.max("_epoch").alias("newest_epoch_ms"))


class LagBoard(StreamingQueryListener):
    """Add it to `spark.streams`; give it to the sink as `board`. keep: micro-batches whose figures are kept."""

    def __init__(self, clock: Callable[[], float] = time.time, keep: int = 1000):
        self.clock = clock
        self._lock = threading.Lock()
        self._waiting: dict[str, deque[tuple[int, int, float]]] = {}
        self._taken: dict[str, tuple[int, int]] = {}
        self._progress: deque[tuple] = deque(maxlen=keep)

    def sealed(self, files: Iterable[tuple[str, int, int]]) -> None:
        """Files that are durable now: stream, epoch, number. A stream's files come in order."""
        now = self.clock()
        with self._lock:
            for stream, epoch, seq in files:
                held = self._waiting.setdefault(stream, deque())
                last = held[-1][:2] if held else self._taken.get(stream, (-1, -1))
                if (epoch, seq) > last:  # a micro-batch that runs again tells of its files again
                    held.append((epoch, seq, now))

    def taken(self, offsets: dict[str, str]) -> None:
        """How far the consumer is done: epoch:number by stream."""
        with self._lock:
            for stream, at in offsets.items():
                place = tuple(int(x) for x in at.split(":"))
                self._taken[stream] = max(self._taken.get(stream, (-1, -1)), place)
                held = self._waiting.get(stream)
                while held and held[0][:2] <= self._taken[stream]:
                    held.popleft()

    def onQueryStarted(self, event) -> None: ...  # noqa: N802

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        m = p.observedMetrics.get(METRICS)
        if m is None:
            return
        with self._lock:
            self._progress.append((p.name or str(p.id), p.batchId, p.timestamp, m["n_rows"], m["oldest_epoch_ms"], m["newest_epoch_ms"]))
        for source in p.sources:
            end = json.loads(source.endOffset) if source.endOffset else {}
            if isinstance(end, dict) and all(isinstance(v, str) for v in end.values()):
                self.taken(end)

    def onQueryIdle(self, event) -> None: ...  # noqa: N802

    def onQueryTerminated(self, event) -> None: ...  # noqa: N802

    def rows(self) -> list[tuple]:
        """Of each stream: files that wait, seconds the oldest has waited, the last file taken."""
        now = self.clock()
        with self._lock:
            out = []
            for stream in sorted(self._waiting.keys() | self._taken.keys()):
                held, at = self._waiting.get(stream) or (), self._taken.get(stream, (None, None))
                out.append((stream, len(held), int(now - held[0][2]) if held else 0, *at))
            return out

    def lag(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SCHEMA)

    def progress(self, spark: SparkSession) -> DataFrame:
        """The observed figures of the last micro-batches."""
        with self._lock:
            return spark.createDataFrame(list(self._progress), PROGRESS)
