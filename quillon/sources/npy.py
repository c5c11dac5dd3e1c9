"""Recordings in NPY files that hold a pickled array of step dicts.

Registered as the format ``recordings``: planned partitions of whole files, only the declared
columns are built, a filter on ``episode_id`` leaves out files, and a writer whose tasks are
committed together. ``decoded`` does the same for tables and streams of path and content, for
stores that only Spark's readers reach. A recording is a whole episode, so positions and flags
follow while it is decoded, without a shuffle.

The unpickler knows the constructors of numpy arrays and nothing else, so a file cannot run
code.
"""

from __future__ import annotations

import ast
import io
import pickle
import re
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from .store import FolderWriter, listed, opened, part_bytes, shared_out

_ALLOWED = {(m, n) for top in ("numpy", "numpy._core", "numpy.core") for m, n in ((f"{top}.multiarray", "_reconstruct"), (f"{top}.multiarray", "scalar"), (f"{top}.numeric", "_frombuffer"))} | {("numpy", "ndarray"), ("numpy", "dtype")}
MOST_BYTES = 1 << 30
BATCH_BYTES = 1 << 24  # of the built columns of a batch, or one step's
PART_BYTES = 1 << 27  # of the files of a partition

#: What the files hold, and what follows from a step's place in its file.
FIELDS = "image binary, wrist_image binary, state array<float>, action array<float>, language_instruction string"
PLACES = "n_steps bigint, is_first boolean, is_last boolean, is_terminal boolean, reward float, discount float"
_ARROW = {"image": pa.binary(), "wrist_image": pa.binary(), "state": pa.list_(pa.float32()), "action": pa.list_(pa.float32()), "language_instruction": pa.string()}


class _Arrays(pickle.Unpickler):
    def find_class(self, module: str, name: str):
        if (module, name) not in _ALLOWED:
            raise pickle.UnpicklingError(f"{module}.{name} is not allowed in a recording")
        return super().find_class(module, name)


def decode(content: bytes) -> list[dict]:
    """The steps of a recording."""
    if content[:6] != b"\x93NUMPY":
        raise ValueError("not an NPY file")
    if len(content) > MOST_BYTES:
        raise ValueError("the recording is too large for a row")
    wide = content[6] > 1
    n = struct.unpack("<I" if wide else "<H", content[8 : 12 if wide else 10])[0]
    start = (12 if wide else 10) + n
    header = ast.literal_eval(content[start - n : start].decode("latin-1"))
    if header["descr"] != "|O" or len(header["shape"]) != 1:
        raise ValueError("not an array of steps")
    steps = list(_Arrays(io.BytesIO(content[start:])).load())
    if len(steps) != header["shape"][0] or not all(isinstance(s, dict) for s in steps):
        raise ValueError("not an array of step dicts")
    return steps


def _cell(x, kind: pa.DataType):
    if x is None:
        return None
    if pa.types.is_binary(kind):
        return np.ascontiguousarray(x, np.uint8).tobytes()
    if pa.types.is_list(kind):
        return np.asarray(x, np.float32).ravel()
    return str(x)


def _column(name: str, path: str, steps: list[dict], first: int, total: int, demo: bool) -> pa.Array:
    """One column of the steps from ``first`` on, of an episode of ``total``."""
    n, at = len(steps), np.arange(first, first + len(steps))
    if name in _ARROW:
        return pa.array([_cell(s.get(name), _ARROW[name]) for s in steps], _ARROW[name])
    of: dict[str, Callable[[], pa.Array]] = {
        "episode_id": lambda: pa.array([path] * n, pa.string()),
        "step_index": lambda: pa.array(at, pa.int64()),
        "n_steps": lambda: pa.array([total] * n, pa.int64()),
        "is_first": lambda: pa.array(at == 0),
        "is_last": lambda: pa.array(at == total - 1),
        "is_terminal": lambda: pa.array((at == total - 1) & demo),
        "reward": lambda: pa.array(((at == total - 1) & demo).astype(np.float32)),
        "discount": lambda: pa.array(np.ones(n, np.float32)),
    }
    if name not in of:
        raise ValueError(f"recordings have no column {name!r}")
    return of[name]()


def batches_of(path: str, content: bytes, columns: Sequence[str], demo: bool = True) -> Iterator[pa.RecordBatch]:
    """The columns of a recording's steps, some steps at a time."""
    steps = decode(content)
    large = [c for c in columns if _ARROW.get(c) == pa.binary()]
    each = max(1, BATCH_BYTES // max(1, max((sum(np.asarray(s[c]).nbytes for c in large if s.get(c) is not None) for s in steps), default=0) + 1024))
    for i in range(0, len(steps), each):
        part = steps[i : i + each]
        yield pa.RecordBatch.from_arrays([_column(c, path, part, i, len(steps), demo) for c in columns], list(columns))


KINDS = dict(x.split() for x in f"episode_id string, step_index bigint, {FIELDS}, {PLACES}".split(", "))


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join(f"{c} {KINDS[c]}" for c in columns)


SOURCE = ("episode_id", "step_index", *_ARROW)
ALL = (*SOURCE, *(x.split()[0] for x in PLACES.split(", ")))


def decoded(files: DataFrame, columns: Sequence[str] = SOURCE, demo: bool = True) -> DataFrame:
    """The columns of each step, of a table or stream of path and content. Recordings without
    a step give no row. In a demonstration the last step is terminal and has reward 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield from batches_of(path, content.as_py(), columns, demo)

    return files.select("path", "content").mapInArrow(run, _ddl(columns))


def read(spark: SparkSession, paths: str | list[str], columns: Sequence[str] = SOURCE, demo: bool = True) -> DataFrame:
    """By Spark's ``binaryFile`` source, from any store that Spark reads."""
    return decoded(spark.read.format("binaryFile").load(paths), columns, demo)


def episode_paths(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The recordings themselves (contents are not read), also those without a step."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(files["path"].alias("episode_id"), files["path"].alias("file_path"), "length")


# --- the format


@dataclass
class Part(InputPartition):
    paths: list[str]


def _read_part(paths: list[str], columns: list[str], demo: bool) -> Iterator[pa.RecordBatch]:
    for path in paths:
        store, name = opened(path)
        with store.open_input_file(name) as f:
            yield from batches_of(path, f.read(), columns, demo)


class _Reader(DataSourceReader):
    def __init__(self, columns: list[str], path: str, most: str | None, demo: bool):
        self.columns, self.path, self.most, self.demo = columns, path, most, demo
        self.wanted: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Files are chosen by ``episode_id``; Spark sees to all other filters."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("episode_id",):
                chosen = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted = chosen if self.wanted is None else self.wanted & chosen
            else:
                yield f

    def partitions(self) -> list[Part]:
        files = [x for x in listed(self.path) if self.wanted is None or x[0] in self.wanted]
        return [Part(x) for x in shared_out(files, part_bytes(files, self.most, PART_BYTES))] or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from _read_part(partition.paths, self.columns, self.demo)


class _StreamReader(DataSourceStreamReader):
    """Files in order of modification time and path. A file must not appear with a time before
    that of one already read; ``streaming.ingest`` keeps a log and has no such rule."""

    def __init__(self, columns: list[str], path: str, most: str | None, demo: bool):
        self.columns, self.path, self.most, self.demo = columns, path, most, demo

    def initialOffset(self) -> dict:  # noqa: N802
        return {"time": 0, "path": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        time, path = max(((t, p) for p, _, t in listed(self.path)), default=(0, ""))
        return {"time": time, "path": path}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        files = [x for x in listed(self.path) if low < (x[2], x[0]) <= high]
        return [Part(x) for x in shared_out(files, part_bytes(files, self.most, PART_BYTES))]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from _read_part(partition.paths, self.columns, self.demo)


def file_name(episode: str) -> str:
    """A name for an episode's file, which is the episode's own as far as file systems allow."""
    plain = re.sub(r"[^\w.=-]", "_", episode, flags=re.ASCII)[-150:]
    return f"{plain}.npy" if plain == episode and plain[:1] not in (".", "_") else f"e-{plain}-{crc32(episode.encode()):08x}.npy"


class _Writer(FolderWriter):
    """One file for each episode. Rows of an episode follow one another (``write`` sees to
    it); a task holds one episode at a time."""

    def __init__(self, folder: str, overwrite: bool, schema: T.StructType):
        super().__init__(folder, overwrite)
        self.names = schema.fieldNames()
        unknown = set(self.names) - set(SOURCE)
        if unknown or "episode_id" not in self.names:
            raise ValueError(f"recordings have an episode_id and some of {SOURCE[1:]}; not {sorted(unknown)}")

    def files(self, batches: Iterator, store, folder: str) -> int:
        rows, held, of = 0, [], None

        def save() -> None:
            steps = np.empty(len(held), object)
            steps[:] = held
            out = io.BytesIO()
            np.save(out, steps, allow_pickle=True)
            with store.open_output_stream(f"{folder}/{file_name(of)}") as f:
                f.write(out.getvalue())

        for b in batches:
            for row in b.to_pylist():
                if row["episode_id"] is None:
                    raise ValueError("a step without an episode_id")
                if row["episode_id"] != of:
                    if held:
                        save()
                    held, of = [], row["episode_id"]
                held.append({k: v if v is None or isinstance(v, str) else np.frombuffer(v, np.uint8) if isinstance(v, bytes) else np.array(v, np.float32) for k, v in row.items() if k not in ("episode_id", "step_index")})
                rows += 1
        if held:
            save()
        return rows


class Recordings(DataSource):
    """Options: ``path``; ``demo`` (true); ``partitionBytes``. The declared schema says which
    columns are built."""

    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return _ddl(ALL)

    def _given(self, schema: T.StructType) -> tuple[list[str], str, str | None, bool]:
        for f in schema:
            if KINDS.get(f.name) != f.dataType.simpleString():
                raise ValueError(f"recordings have no column {f.name} {f.dataType.simpleString()}")
        return schema.fieldNames(), self.options["path"], self.options.get("partitionbytes"), self.options.get("demo", "true").lower() == "true"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(*self._given(schema))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(*self._given(schema))

    def writer(self, schema: T.StructType, overwrite: bool) -> FolderWriter:
        return _Writer(self.options["path"], overwrite, schema)


def scan(spark: SparkSession, path: str, columns: Sequence[str] = SOURCE, demo: bool = True) -> DataFrame:
    """Recordings by the format ``recordings``, which this registers; filters reach Python data
    sources only with a setting of the session, which is turned on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Recordings)
    return spark.read.format("recordings").schema(_ddl(columns)).option("demo", str(demo).lower()).load(path)


def write(steps: DataFrame, path: str, overwrite: bool = False) -> None:
    """A recording for each episode: one exchange brings its steps together, in order. An
    episode is one file, so it has to fit into a task's memory."""
    spark = steps.sparkSession
    spark.dataSource.register(Recordings)
    names = [c for c in SOURCE if c in steps.columns]
    out = steps.select(*names).repartition("episode_id").sortWithinPartitions("episode_id", "step_index")
    out.write.format("recordings").mode("overwrite" if overwrite else "append").save(path)
