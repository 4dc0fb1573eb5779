"""Frame archives as a Spark data source: zip files of one array a frame, read by range and written in one commit.

``spark.read.format("frame_archive")`` gives (stream, frame_idx, r, c, value). An archive holds
consecutive frames of one stream, which its path tells: <stream>/<first>-<last>-<task>.zip. So a
filter on stream or frame_idx picks archives without opening them, and inside one the members:
a range of a long stream reads its frames alone. Tasks write archives beside the place and the driver moves
those of successful tasks there at the end, so that a retried task leaves nothing twice.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

FORMAT = "frame_archive"
SCHEMA = "stream string, frame_idx long, r long, c long, value double"
_NAME = re.compile(r"(\d+)-(\d+)-[0-9a-f]+\.zip")
_LEAST, _MOST = 0, (1 << 63) - 1


def _storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))
    return fs.LocalFileSystem(), path


@dataclass
class Span(InputPartition):
    """Frames ``low`` to ``high`` of an archive."""

    stream: str
    path: str
    low: int
    high: int


@dataclass
class Written(WriterCommitMessage):
    """Archives of a task: (staged path, final path)."""

    moves: list[tuple[str, str]]


def _loaded(z: zipfile.ZipFile, name: str) -> np.ndarray | None:
    try:
        return np.load(io.BytesIO(z.read(name)))
    except (ValueError, EOFError, OSError, zipfile.BadZipFile):
        return None


def _shape(z: zipfile.ZipFile, names: Sequence[str]) -> tuple[int, ...] | None:
    """The shape of the first of the members whose header can be read."""
    for name in names:
        try:
            with z.open(name) as member:
                np.lib.format.read_magic(member)
                return np.lib.format.read_array_header_1_0(member)[0]
        except (ValueError, EOFError, OSError, zipfile.BadZipFile):
            continue
    return None


def frames_of(z: zipfile.ZipFile, low: int, high: int, permissive: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(frame, array) of an archive's frames from ``low`` to ``high``; no other member is read whole.

    A damaged frame is NaN throughout, in the size of the last good one before it, or else of
    the first after it; where there is none it is left out. Unless permissive it is an error.
    """
    names = sorted((int(n.split(".")[0]), n) for n in z.namelist())
    last = None
    for at, (frame, name) in enumerate(names):
        if not low <= frame <= high:
            continue
        x = _loaded(z, name)
        if x is None:
            if not permissive:
                raise ValueError(f"frame {frame} can't be read")
            last = last or _shape(z, [n for _, n in reversed(names[:at])]) or _shape(z, [n for _, n in names[at + 1 :]])
            x = None if last is None else np.full(last, np.nan)
        else:
            last = x.shape
        if x is not None:
            yield frame, x


class ArchiveReader(DataSourceReader):
    """Plans one partition for every ``frames`` frames of an archive that the filters leave."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.permissive = options["path"], options.get("permissive", "true").lower() == "true"
        self.frames = int(options.get("frames", "64"))
        self.low, self.high, self.streams = _LEAST, _MOST, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes conditions on frame_idx and stream; the others are Spark's."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column == "frame_idx" and isinstance(f, EqualTo):
                self.low, self.high = max(self.low, f.value), min(self.high, f.value)
            elif column == "frame_idx" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif column == "frame_idx" and isinstance(f, LessThan | LessThanOrEqual):
                self.high = min(self.high, f.value - isinstance(f, LessThan))
            elif column == "stream" and isinstance(f, EqualTo | In):
                own = set(f.value) if isinstance(f, In) else {f.value}
                self.streams = own if self.streams is None else self.streams & own
            else:
                yield f

    def partitions(self) -> list[Span]:
        store, root = _storage(self.path)
        out = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            name = _NAME.fullmatch(info.base_name)
            folder = info.path.rsplit("/", 1)[0]
            stream = folder.removeprefix(root.rstrip("/")).lstrip("/")
            if not name or (self.streams is not None and stream not in self.streams) or stream.startswith("_"):
                continue
            low, high = max(self.low, int(name[1])), min(self.high, int(name[2]))
            out += [Span(stream, info.path, at, min(at + self.frames - 1, high)) for at in range(low, high + 1, self.frames)]
        return out or [Span("", "", 0, -1)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if partition.path:
            store, _ = _storage(self.path)
            with store.open_input_file(partition.path) as file, zipfile.ZipFile(file) as z:
                for frame, x in frames_of(z, partition.low, partition.high, self.permissive):
                    r, c = np.indices(x.shape)
                    columns = [np.full(x.size, frame), r.ravel(), c.ravel(), x.ravel().astype(float)]
                    yield pa.RecordBatch.from_arrays([pa.array([partition.stream] * x.size, pa.string()), *map(pa.array, columns)], names=["stream", "frame_idx", "r", "c", "value"])


class ArchiveWriter(DataSourceArrowWriter):
    """Writes rows that come sorted by (stream, frame_idx); a new archive begins with a stream or after ``frames`` numbers."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.frames = options["path"], int(options.get("frames", "64"))
        self.dtype, self.staging = np.dtype(options.get("dtype", "float32")), f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _storage(self.path)
        moves, held, key = [], [], None

        def close() -> None:
            if not held:
                return
            stream, _ = key
            name = f"{held[0][0]:09d}-{held[-1][0]:09d}-{uuid.uuid4().hex}.zip"
            staged = f"{root}/{self.staging}/{stream}/{name}"
            store.create_dir(staged.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(staged) as file:
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for frame, raw in held:
                        z.writestr(f"{frame:09d}.npy", raw)
                file.write(out.getvalue())
            moves.append((staged, f"{root}/{stream}/{name}"))
            held.clear()

        parts: list[np.ndarray] = []
        frame = None

        def keep() -> None:
            if frame is not None:
                rows = np.concatenate(parts)
                r, c = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64)
                grid = np.full((r.max() + 1, c.max() + 1), np.nan if self.dtype.kind == "f" else 0, self.dtype)
                grid[r, c] = rows[:, 2]
                raw = io.BytesIO()
                np.save(raw, grid)
                held.append((frame, raw.getvalue()))
            parts.clear()

        for b in iterator:
            streams, numbers = b.column("stream").to_pylist(), b.column("frame_idx").to_numpy()
            values = np.stack([b.column(n).to_numpy(zero_copy_only=False).astype(float) for n in ("r", "c", "value")], 1)
            cuts = [0, *(k for k in range(1, len(numbers)) if numbers[k] != numbers[k - 1] or streams[k] != streams[k - 1]), len(numbers)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                now = (streams[lo], int(numbers[lo]) // self.frames) if hi > lo else key
                if hi > lo and (now != key or numbers[lo] != frame):
                    keep()
                    if now != key:
                        close()
                    key, frame = now, int(numbers[lo])
                parts.append(values[lo:hi])
        keep()
        close()
        return Written(moves)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _storage(self.path)
        for m in messages:
            for staged, final in m.moves if m else ():
                store.create_dir(final.rsplit("/", 1)[0], recursive=True)
                store.move(staged, final)
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_storage(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staging}")


class FrameArchives(DataSource):
    """Options: path; frames, how many an archive or a read task holds; dtype of what is written; permissive reading."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> ArchiveReader:
        return ArchiveReader(dict(self.options))

    def writer(self, schema: object, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options))


def _known(spark: SparkSession) -> None:
    spark.dataSource.register(FrameArchives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archives(rows: DataFrame, path: str, frames: int = 64, dtype: str = "float32") -> None:
    """Write (stream, frame_idx, r, c, value) as archives of at most ``frames`` frames; they join what is there.

    A frame is one task's, with all its rows; one that repeats a pixel keeps one of its values. A null stream,
    frame or place is an error of the rows and must be filtered before.
    """
    _known(rows.sparkSession)
    chunk = F.floor(F.col("frame_idx") / frames)
    picked = rows.select(F.col("stream").cast("string"), F.col("frame_idx").cast("long"), F.col("r").cast("long"), F.col("c").cast("long"), F.col("value").cast("double"))
    dealt = picked.repartition("stream", chunk).sortWithinPartitions("stream", "frame_idx", "r", "c")
    dealt.write.format(FORMAT).option("frames", frames).option("dtype", dtype).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, permissive: bool = True, frames: int = 64) -> DataFrame:
    """(stream, frame_idx, r, c, value) of the archives below ``path``; conditions on stream and frame_idx pick members."""
    _known(spark)
    return spark.read.format(FORMAT).option("permissive", str(permissive).lower()).option("frames", frames).load(path)
