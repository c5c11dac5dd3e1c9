"""Folders that the driver and all executors share.

The driver moves and deletes through Hadoop's file systems, tasks of the Python data sources
open files through Arrow's. Both know mounted folders; what else they reach depends on the
libraries that the cluster has.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

_own_folder: str | None = None


def working_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, which only local mode may
    leave, a temporary folder of this process."""
    global _own_folder
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = "file://" + tempfile.mkdtemp(prefix="quillon-data-")
    return _own_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Files:
    """Names below a folder, as the driver sees them; hidden ones are left out."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf, self.folder = spark._jvm, spark._jsc.hadoopConfiguration(), folder.rstrip("/")
        self._gateway = spark.sparkContext._gateway
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._path(name)):
            return []
        return sorted(n for x in self._fs.listStatus(self._path(name)) if not (n := x.getPath().getName()).startswith("."))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)

    def publish(self, name: str, text: str) -> bool:
        """A new file with the whole text, or False if there is one of that name. Nobody sees
        a part of it, and of several writers one succeeds."""
        own = self._path(f".{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(own, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        final = self._path(name)
        self._fs.mkdirs(final.getParent())
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(own, final, none)
            return True
        except Exception as e:
            self._fs.delete(own, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise


def listed(pattern: str) -> list[tuple[str, int, int]]:
    """Path, bytes and modification time (ns) of the files that a path, a folder or a pattern
    of a file name names, hidden ones left out, in order of path. Folders are searched through."""
    store, path = opened(pattern)
    top, _, name = path.rpartition("/")
    plain = not any(c in name for c in "*?[")
    if plain and store.get_file_info(path).type == fs.FileType.Directory:
        top, name = path, "*"
    found = store.get_file_info(fs.FileSelector(top, allow_not_found=True, recursive=True))
    scheme, there, rest = pattern.partition("://")
    lead = "" if not there else f"{scheme}://" + rest.partition("/")[0] * path.startswith("/")
    files = [x for x in found if x.type == fs.FileType.File and fnmatch(x.base_name, name) and not any(p[:1] in (".", "_") for p in x.path[len(top) :].split("/"))]
    return sorted((lead + x.path, x.size, x.mtime_ns) for x in files)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it, whose characters all stand for
    themselves."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    scheme, there, rest = path.partition("://")
    if not there:
        return fs.LocalFileSystem(), path
    top, _, below = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{top}/")
    return store, f"{base.rstrip('/')}/{below}"


LEAST_PART, PARTS = 1 << 20, 64


def part_bytes(files: list[tuple[str, int, int]], given: str | None, most: int) -> int:
    """Bytes of a partition: what is given, else ``most``, or less where that makes few
    partitions of small files."""
    return int(given) if given else min(most, max(LEAST_PART, sum(n for _, n, _ in files) // PARTS))


def shared_out(files: list[tuple[str, int, int]], most: int) -> Iterator[list[str]]:
    """Consecutive files of ``most`` bytes together, or one that is larger."""
    part: list[str] = []
    held = 0
    for path, size, _ in files:
        if part and held + size > most:
            yield part
            part, held = [], 0
        part.append(path)
        held += size
    if part:
        yield part


@dataclass
class Written(WriterCommitMessage):
    folder: str
    rows: int


class FolderWriter(DataSourceArrowWriter):
    """Tasks write files to folders of their own under ``_staging``; the commit moves those of
    the attempts that ended well, a rename for each task, and drops the rest. An overwrite then
    deletes what was there before; a driver that dies in between leaves both, and loses nothing.
    Subclasses say what a task writes."""

    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder.rstrip("/"), overwrite, uuid.uuid4().hex

    def files(self, batches: Iterator, store: fs.FileSystem, folder: str) -> int:
        """Writes the batches' files and returns the number of rows."""
        raise NotImplementedError

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        store, top = opened(self.folder)
        own = f"part-{uuid.uuid4().hex}"
        store.create_dir(f"{top}/_staging/{self.job}/{own}", recursive=True)
        return Written(own, self.files(iterator, store, f"{top}/_staging/{self.job}/{own}"))

    def commit(self, messages: list) -> None:
        store, top = opened(self.folder)
        old = store.get_file_info(fs.FileSelector(top, allow_not_found=True)) if self.overwrite else []
        for m in messages:
            if m is not None and m.rows:
                store.move(f"{top}/_staging/{self.job}/{m.folder}", f"{top}/{m.folder}")
        for x in old:
            if x.base_name != "_staging":
                (store.delete_dir if x.type == fs.FileType.Directory else store.delete_file)(x.path)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        store, top = opened(self.folder)
        if store.get_file_info(f"{top}/_staging/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{top}/_staging/{self.job}")
        if not store.get_file_info(fs.FileSelector(f"{top}/_staging", allow_not_found=True)):
            if store.get_file_info(f"{top}/_staging").type == fs.FileType.Directory:
                store.delete_dir(f"{top}/_staging")
