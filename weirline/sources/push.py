"""A push source: batches with inclusive offset ranges, as a stream. In production Kafka takes its place;
this one replays rows from a Parquet file by partition and offset, for tests and demonstrations."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, InputPartition, SimpleDataSourceStreamReader


class ReplaySource(DataSource):
    """Options: partitions, per_poll (rows a partition gives at a time), total (rows of each partition).

    Columns: partition, offset, id, name; ids repeat, so that upserts have something to do.
    """

    @classmethod
    def name(cls) -> str:
        return "weirline_replay"

    def schema(self) -> str:
        return "partition int, offset long, id long, name string"

    def simpleStreamReader(self, schema):  # noqa: N802
        return _Replay(self.options)


class _Replay(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.partitions, self.per_poll, self.total = int(options.get("partitions", 1)), int(options.get("per_poll", 1000)), int(options.get("total", 10_000))
        self.keys = int(options.get("keys", 10_000))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": 0}

    def _rows(self, start: int, end: int) -> Iterator[tuple]:
        for p in range(self.partitions):
            for o in range(start, end):
                yield p, o, p * 1_000_000 + o % self.keys, f"name-{p}-{o}"

    def read(self, start: dict):
        end = min(self.total, start["at"] + self.per_poll)
        return iter(list(self._rows(start["at"], end))), {"at": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self._rows(start["at"], end["at"])

    def commit(self, end: dict) -> None: ...


__all__ = ["InputPartition", "ReplaySource"]
