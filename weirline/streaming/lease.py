"""One live writer a stream: a lease object with a heartbeat. Not atomic on every store; it narrows the gap."""

from __future__ import annotations

import json
import os
import socket
import time
import uuid
from collections.abc import Callable

from ..errors import StorageError, WriterFenced, WriterLocked
from ..sources.store import Store


class Lease:
    """settle: seconds between writing over another's lease and reading it back. wait, poll: seconds for which, and
    between which, a live lease is looked at before its holder is named as the reason to give up."""

    def __init__(self, store: Store, key: str, timeout: float, clock: Callable[[], float] = time.time, settle: float = 1.0, wait: float = 0.0, poll: float = 2.0, sleep: Callable[[float], None] = time.sleep):
        self.store, self.key, self.timeout, self.clock, self.settle, self.wait, self.poll, self.sleep = store, key, timeout, clock, settle, wait, poll, sleep
        self.owner = {"uuid": uuid.uuid4().hex, "host": socket.gethostname(), "pid": os.getpid()}
        self.verified_at = clock()

    def _free(self, held: dict) -> bool:
        """Whether another's lease may be taken: it is stale, or its process on this host is gone."""
        if self.clock() - held["heartbeat"] > self.timeout:
            return True
        if held["host"] != self.owner["host"]:
            return False
        try:
            os.kill(held["pid"], 0)
        except ProcessLookupError:
            return True
        except OSError:
            return False
        return False

    def _text(self) -> str:
        return json.dumps(self.owner | {"heartbeat": self.clock()})

    def acquire(self) -> None:
        began = self.clock()
        while True:
            held = self.store.get_json(self.key)
            if held is None:
                if self.store.create(self.key, self._text()):
                    self.verified_at = self.clock()
                    return
                continue
            if self._free(held):
                self.store.put(self.key, self._text())
                self.sleep(self.settle)
                self.verify()
                return
            if self.clock() - began >= self.wait:
                raise WriterLocked(f"{self.key} is held by process {held['pid']} on {held['host']}")
            self.sleep(self.poll)

    def verify(self) -> None:
        """Raise unless the lease is still ours. A store that can't be read is borne for as long as the lease lasts."""
        try:
            held = self.store.get_json(self.key)
        except StorageError as e:
            if self.clock() - self.verified_at > self.timeout:
                raise WriterFenced(f"{self.key} can't be read for longer than the lease lasts") from e
            raise
        if not held or held["uuid"] != self.owner["uuid"]:
            raise WriterFenced(f"{self.key} was taken over")
        self.verified_at = self.clock()

    def heartbeat(self) -> None:
        self.verify()
        self.store.put(self.key, self._text())

    def release(self) -> None:
        for attempt in range(3):
            try:
                held = self.store.get_json(self.key)
                if held and held["uuid"] == self.owner["uuid"]:
                    self.store.delete(self.key)
                return
            except Exception:
                if attempt == 2:
                    raise
