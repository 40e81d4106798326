"""Settings of the engine, their ranges, and the check of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum

from .errors import ConfigError
from .functions.csv_dialect import check_delimiter

MIB, SEC, MINUTE, HOUR, DAY = 1 << 20, 1.0, 60.0, 3600.0, 86400.0


class Mode(Enum):
    UPSERT = "upsert"
    INSERT_ONLY = "insert"


class Compression(Enum):
    GZIP = "gzip"
    NONE = "none"


#: Smallest and largest value of each setting (fixed values).
RANGES = {
    "rotate_size_bytes": (1, 512 * MIB),
    "rotate_interval_max": (1 * SEC, 6 * HOUR),
    "gc_interval": (15 * MINUTE, 7 * DAY),
    "gc_retain_days": (1, 365),
    "gc_retain_min_files": (3, 1_000_000),
    "lock_heartbeat_interval": (1 * SEC, 600 * SEC),
    "staging_refresh_interval": (30 * SEC, 24 * HOUR),
    "rotation_queue_depth": (1, 16),
    "staging_error_after_attempts": (1, 10_000),
    "lag_sample_interval": (1 * SEC, 1 * HOUR),
    "state_heartbeat_interval": (1 * MINUTE, 1 * DAY),
}


def backoff(attempt: int) -> float:
    """Seconds to wait after the attempt of this number (from 1)."""
    return min(30.0, 2.0 ** (attempt - 1))


@dataclass
class Credentials:
    key_id: str = field(repr=False)
    secret: str = field(repr=False)

    def check(self) -> None:
        for name, value in (("key id", self.key_id), ("secret", self.secret)):
            if not value or "," in value or '"' in value:
                raise ConfigError(f"the {name} is empty or holds a comma or a quote")


@dataclass
class Config:
    """root: the folder, on a store that all executors reach, of staging, ledger and tables."""

    root: str
    cluster_id: str = "c0"
    rotate_size_bytes: int = 64 * MIB
    rotate_interval_max: float = 15 * SEC
    #: None: tried again without end; 0: fails at once.
    retry_max: int | None = 15
    gc_interval: float = 1 * HOUR
    gc_retain_days: float = 7
    gc_retain_min_files: int = 50_000
    lock_heartbeat_interval: float = 30 * SEC
    lock_lease_timeout: float = 180 * SEC
    staging_refresh_interval: float = 5 * MINUTE
    rotation_queue_depth: int = 3
    #: Attempts at staging a file after which its writer reports the failure; the file stays and is tried again.
    staging_error_after_attempts: int = 3
    lag_sample_interval: float = 30 * SEC
    state_heartbeat_interval: float = 4 * HOUR
    #: Seconds for which opening waits for a live lease to be released, and that a lease taken over settles.
    lock_wait: float = 10 * SEC
    lock_settle: float = 1 * SEC
    delimiter: str = ","
    mode: Mode = Mode.UPSERT
    compression: Compression = Compression.GZIP
    #: Files of a load's part of a target table, dealt by key.
    buckets: int = 64
    credentials: Credentials | None = None
    #: Gives credentials anew, every staging_refresh_interval and once where the store denies access.
    refresh: Callable[[], Credentials] | None = None
    #: Whether writers run their chores (age, heartbeat, lag, state, clean-up) in a thread; else call `tick`.
    ticker: bool = True
    bypass_range_checks: bool = False

    def check(self) -> Config:
        if not self.root:
            raise ConfigError("a root is asked for")
        check_delimiter(self.delimiter)
        if self.buckets < 1:
            raise ConfigError("a table has at least one bucket")
        if self.credentials:
            self.credentials.check()
        if self.bypass_range_checks:
            return self
        for name, (low, high) in RANGES.items():
            if not low <= getattr(self, name) <= high:
                raise ConfigError(f"{name} is {getattr(self, name)}; it goes from {low} to {high}")
        if not 3 * self.lock_heartbeat_interval <= self.lock_lease_timeout <= DAY:
            raise ConfigError("lock_lease_timeout is three heartbeats at least and a day at most")
        if self.retry_max is not None and self.retry_max < 0:
            raise ConfigError("retry_max can't be negative")
        # Staged files outlive what may still want them: a takeover, and all tries of a load.
        horizon = self.lock_lease_timeout + sum(backoff(k) for k in range(1, (self.retry_max or 0) + 1))
        if horizon >= self.gc_retain_days * DAY:
            raise ConfigError(f"a takeover and retries may take {horizon:.0f} s, longer than staged files are kept")
        return self
