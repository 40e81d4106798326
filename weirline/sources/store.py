"""Small objects and listings on any store that Hadoop's file systems reach, from the driver; no Spark jobs."""

from __future__ import annotations

import contextlib
import json
import os
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import StorageError


#: Schemes of file systems whose move fails where the target is, and of stores that write a new object only where there is
#: none when they are told not to overwrite (fixed values); the option by which Hadoop's stores write an
#: object only where there is none (fixed value).
MOVES_ONCE = ("hdfs", "viewfs", "webhdfs", "ofs", "abfs", "abfss")
NEW_ONCE = ("gs",)
CONDITIONAL = "fs.option.create.conditional.overwrite"


def normal_root(root: str) -> str:
    """A root without slashes at its end or doubled ones inside; the scheme's own stay."""
    scheme, sep, rest = root.partition("://")
    if not sep:
        scheme, rest = "", root
    lead = "/" if rest.startswith("/") else ""
    return scheme + sep + lead + "/".join(p for p in rest.split("/") if p)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, normal_root(root)
        context = spark.sparkContext
        self._jvm, self._gateway, self._conf = context._jvm, context._gateway, context._jsc.hadoopConfiguration()
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"
        self._here = self._fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(self.root)).toUri().getPath() if self._local else None

    def path(self, key: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}" if key else self.root)

    def uri(self, key: str) -> str:
        """The object's full address."""
        return self._fs.makeQualified(self.path(key)).toString().replace("file:/", "file:///", 1) if self._local else self._fs.makeQualified(self.path(key)).toString()

    def local(self, key: str) -> str | None:
        """The object's path on a local disk; None on other stores."""
        return f"{self._here}/{key}" if self._local else None

    def list(self, folder: str) -> list[tuple[str, int]]:
        """Names and sizes of the files in a folder, sub-folders left out, sorted; none if there is no folder."""
        path = self.path(folder)
        if not self._fs.exists(path):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(path) if s.isFile())

    def folders(self, folder: str) -> list[tuple[str, int]]:
        """Names of the sub-folders of a folder and when they last changed, in ms; sorted."""
        path = self.path(folder)
        if not self._fs.exists(path):
            return []
        return sorted((s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(path) if s.isDirectory())

    def walk(self, folder: str) -> list[tuple[str, int]]:
        """Keys and sizes of all files below a folder, but for those whose names begin with _ or a dot."""
        path, out = self.path(folder), []
        if not self._fs.exists(path):
            return []
        top = self._fs.makeQualified(path).toString().rstrip("/")
        found = self._fs.listFiles(path, True)
        while found.hasNext():
            s = found.next()
            if s.getPath().getName()[0] not in "_.":
                out.append((folder + self._fs.makeQualified(s.getPath()).toString()[len(top) :], s.getLen()))
        return out

    def below(self, folder: str) -> list[tuple[str, int]]:
        """Keys and sizes of the files in a folder's sub-folders, but for those whose names begin with _ or a dot. Listed by two
        calls, whose answers have no owners and permissions: Hadoop's local file system starts a process for those of each file."""
        if not self._fs.exists(self.path(folder)):
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
        tops, out = paths(self._fs.listStatus(self.path(folder))), []
        for s in self._fs.listStatus(tops):
            home, name = s.getPath().toString().rsplit("/", 2)[1:]
            if name[0] not in "_.":
                out.append((f"{folder}/{home}/{name}", s.getLen()))
        return out

    def _move_here(self, source: str, target: str) -> None:
        """A move on the driver's own disk. The file's checksum goes after it: until then it is read without one, and never
        by that of the file before."""
        old, new = (f"{self._here}/{key}".rpartition("/") for key in (source, target))
        old_sum, new_sum = (f"{folder}/.{name}.crc" for folder, _, name in (old, new))
        os.makedirs(new[0], exist_ok=True)
        if os.path.exists("".join(old)):
            with contextlib.suppress(FileNotFoundError):
                os.unlink(new_sum)
        os.replace("".join(old), "".join(new))
        with contextlib.suppress(FileNotFoundError):
            os.replace(old_sum, new_sum)

    def move(self, source: str, target: str) -> None:
        """An object to another place, over what is there."""
        if self._local:
            # Hadoop's own move starts several processes a file here.
            try:
                return self._move_here(source, target)
            except OSError as e:
                raise StorageError(f"{source} could not be moved to {target}") from e
        to = self.path(target)
        self._fs.mkdirs(to.getParent())
        try:
            self._rename(self.path(source), to, overwrite=True)
        except Py4JJavaError as e:
            raise StorageError(f"{source} could not be moved to {target}") from e

    def exists(self, key: str) -> bool:
        return self._fs.exists(self.path(key))

    def delete(self, key: str) -> bool:
        return self._fs.delete(self.path(key), True)

    def _beside(self, key: str, data: bytes):
        """The content under a name of its own."""
        path = self.path(f"{key}.{uuid.uuid4().hex}.writing")
        self._fs.mkdirs(path.getParent())
        out = self._fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        return path

    def _rename(self, source, target, overwrite: bool) -> None:
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE if overwrite else kind.NONE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self._conf).rename(source, target, options)

    def put(self, key: str, content: str | bytes) -> None:
        """The whole object or the one before: written beside, then moved over what is there in one step."""
        beside = self._beside(key, content.encode() if isinstance(content, str) else content)
        try:
            self._rename(beside, self.path(key), overwrite=True)
        except Py4JJavaError as e:
            self._fs.delete(beside, False)
            raise StorageError(f"{key} could not be moved into place") from e

    def create(self, key: str, content: str) -> bool:
        """The whole object, only where nothing is yet; whether it was written. Of several at once one succeeds.

        Where the store writes an object only if there is none (S3 with conditional writes) it is asked to; on file systems a link or a move
        that doesn't overwrite does it. On other object stores, where a move is a copy, it fails: two writers could both succeed.
        """
        how = self._exclusive()
        if how in ("conditional", "new"):
            return self._create_if_none(key, content.encode(), how)
        if how is None:
            raise StorageError(f"{self.root}: this store can't create an object only where there is none")
        beside, target = self._beside(key, content.encode()), self.path(key)
        try:
            if self._local:
                os.link(beside.toUri().getPath(), target.toUri().getPath())
            elif self._fs.exists(target):
                return False
            else:
                self._rename(beside, target, overwrite=False)
            return True
        except FileExistsError:
            return False
        except Py4JJavaError as e:
            if self._fs.exists(target):
                return False
            raise StorageError(f"{key} could not be created") from e
        finally:
            self._fs.delete(beside, False)

    def _exclusive(self) -> str | None:
        """How an object is created at most once: by a link or a move, by a condition, or not at all."""
        if self._local or self._fs.getUri().getScheme() in MOVES_ONCE:
            return "move"
        if self._fs.getUri().getScheme() in NEW_ONCE:
            return "new"
        return "conditional" if self._fs.hasPathCapability(self.path(""), CONDITIONAL) else None

    def _create_if_none(self, key: str, data: bytes, how: str) -> bool:
        """The store itself refuses the second of two at once, when the object is closed."""
        target = self.path(key)
        try:
            out = self._fs.create(target, False) if how == "new" else self._fs.createFile(target).must(CONDITIONAL, True).recursive().build()
            try:
                out.write(bytearray(data))
            finally:
                out.close()
            return True
        except Py4JJavaError as e:
            if self._fs.exists(target):
                return False
            raise StorageError(f"{key} could not be created") from e

    def get(self, key: str) -> str | None:
        """The object's text; None if there is none."""
        try:
            source = self._fs.open(self.path(key))
        except Py4JJavaError as e:
            if not self._fs.exists(self.path(key)):
                return None
            raise StorageError(f"{key} could not be read") from e
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def get_json(self, key: str) -> Any | None:
        """The object parsed; None if there is none; an error if it is damaged."""
        text = self.get(key)
        if text is None:
            return None
        try:
            return json.loads(text)
        except ValueError as e:
            raise StorageError(f"{key} is damaged") from e
