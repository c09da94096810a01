"""Following files that grow: bytes appended to a log become rows of a stream.

A stream's offset is the number of bytes read per file. A file is known by its inode where the store has one, so a
log that is renamed on rotation is read on to its end under its new name, as long as that name is followed
too; else by its path. The first bytes of a file are remembered by their checksum: a log that was cut off and begun
anew is read from its start. A last line without its line break is held back until the break has been written.
"""

from __future__ import annotations

import fnmatch
import os
import posixpath
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any, BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from roompulse.session import importable

FORMAT = "tail_lines"
SCHEMA = "value string, source string, position long"
#: Bytes of a file that one task reads, bytes that it holds at a time, and bytes that tell files apart.
TASK_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
HEAD_BYTES = 256


class FollowedFiles:
    """The files of a folder, a single file or a name pattern: their identity, path and size."""

    def __init__(self, path: str):
        self.store, self.path = None, path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")
        if "://" in self.path:
            self.store, self.path = pyarrow.fs.FileSystem.from_uri(self.path)

    def _entries(self) -> Iterator[tuple[str, int, str | None]]:
        """Path, size and inode."""
        if self.store is not None:
            folder, pattern = self.path, "*"
            if self.store.get_file_info(folder).type != pyarrow.fs.FileType.Directory:
                folder, pattern = posixpath.split(self.path)
            for info in self.store.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)):
                if info.is_file and fnmatch.fnmatchcase(info.base_name, pattern):
                    yield info.path, info.size, None
            return
        folder, pattern = (self.path, "*") if os.path.isdir(self.path) else os.path.split(self.path)
        if not os.path.isdir(folder or "."):
            return
        with os.scandir(folder or ".") as entries:
            for entry in entries:
                if fnmatch.fnmatchcase(entry.name, pattern) and entry.is_file():
                    found = os.stat(entry.path)
                    yield entry.path, found.st_size, f"{found.st_ino}"

    def found(self) -> dict[str, tuple[str, int]]:
        """Path and size by identity; hidden files and those of other writers' bookkeeping are left out."""
        return {
            inode or path: (path, size) for path, size, inode in self._entries()
            if not posixpath.basename(path).startswith((".", "_"))}

    @contextmanager
    def open(self, path: str) -> Iterator[BinaryIO]:
        with self.store.open_input_file(path) if self.store is not None else open(path, "rb") as file:
            yield file

    @contextmanager
    def open_known(self, identity: str, path: str) -> Iterator[BinaryIO]:
        """Open a file that may have been renamed since its path was found."""
        if self.store is None:
            file = open(path, "rb") if os.path.exists(path) else None
            if file is not None and f"{os.fstat(file.fileno()).st_ino}" != identity:
                file.close()
                file = None
            if file is None:
                file = open(self.found()[identity][0], "rb")
            with file:
                yield file
        else:
            with self.open(path) as file:
                yield file


def _head(file: BinaryIO, size: int) -> list[int]:
    """Length and checksum of a file's first bytes."""
    file.seek(0)
    return [min(size, HEAD_BYTES), zlib.crc32(file.read(min(size, HEAD_BYTES)))]


def _last_break(file: BinaryIO, size: int) -> int:
    """Where the last whole line ends, searched backwards."""
    end = size
    while end:
        begin = max(0, end - BLOCK_BYTES)
        file.seek(begin)
        at = file.read(end - begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return 0


class FilePart(InputPartition):
    """The lines that begin in a range of a file's bytes."""

    def __init__(self, identity: str, path: str, begin: int, end: int, whole_end: int):
        self.identity, self.path, self.begin, self.end, self.whole_end = identity, path, begin, end, whole_end


class TailReader(DataSourceStreamReader):
    """Offsets are ``{identity: [bytes read, length of the head, checksum of the head]}``."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.strict = options.get("failOnDataLoss", "true").lower() != "false"
        self.from_end = options.get("startingOffsets", "earliest") == "latest"

    def _now(self) -> dict[str, Any]:
        files = FollowedFiles(self.path)
        out = {}
        for identity, (path, size) in files.found().items():
            try:
                with files.open_known(identity, path) as file:
                    read = _last_break(file, size)
                    out[identity] = [read, *_head(file, read)]
            except (FileNotFoundError, KeyError):  # deleted since it was listed
                continue
        return out

    def initialOffset(self) -> dict[str, Any]:
        return self._now() if self.from_end else {}

    def latestOffset(self) -> dict[str, Any]:
        return self._now()

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[FilePart]:
        files = FollowedFiles(self.path)
        found = files.found()
        parts = []
        for identity, (stop, *_) in sorted(end.items()):
            begin, length, checksum = start.get(identity, (0, 0, 0))
            if begin == stop and start.get(identity) == end[identity]:
                continue
            if identity not in found:
                if self.strict:
                    raise FileNotFoundError(f"a followed file of {self.path} is gone before bytes {begin} to {stop} of it were read")
                continue
            path = found[identity][0]
            if begin:
                with files.open_known(identity, path) as file:
                    if begin > stop or _head(file, length) != [length, checksum]:
                        begin = 0  # cut off and begun anew
            for first in range(begin, stop, TASK_BYTES):
                parts.append(FilePart(identity, path, first, min(first + TASK_BYTES, stop), stop))
        return parts

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        files = FollowedFiles(self.path)
        with files.open_known(partition.identity, partition.path) as file:
            at, end, stop = partition.begin, partition.end, partition.whole_end
            if at:  # a line that began before this range is another task's
                file.seek(at - 1)
                at = _next_line(file, at - 1, stop)
            file.seek(at)
            held = b""
            begin = at
            while begin < end:
                block = file.read(min(BLOCK_BYTES, stop - begin - len(held)))
                if not block:
                    raise EOFError(f"{partition.path} ends before byte {stop}")
                held += block
                cut = held.rfind(b"\n") + 1
                if not cut:
                    continue
                lines = held[:cut].split(b"\n")[:-1]
                yield _batch(lines, begin, end, partition.identity)
                held, begin = held[cut:], begin + cut

    def commit(self, end: dict[str, Any]) -> None:
        pass


def _next_line(file: BinaryIO, at: int, stop: int) -> int:
    """The first line that begins after position ``at``."""
    while at < stop:
        block = file.read(min(BLOCK_BYTES, stop - at))
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        if not block:
            break
        at += len(block)
    return stop


def _batch(lines: list[bytes], begin: int, end: int, identity: str) -> pa.RecordBatch:
    """Lines from a position on, those only that begin before ``end``; bytes that are no UTF-8 are replaced."""
    positions = []
    for line in lines:
        if begin >= end:
            break
        positions.append(begin)
        begin += len(line) + 1
    kept = [line[:-1] if line.endswith(b"\r") else line for line in lines[:len(positions)]]
    text = [line.decode("utf-8", "replace") for line in kept]
    return pa.RecordBatch.from_arrays(
        [pa.array(text, pa.string()), pa.array([identity] * len(text), pa.string()), pa.array(positions, pa.int64())],
        names=["value", "source", "position"])


class TailLines(DataSource):
    """Lines appended to the files of ``path`` (a file, a folder, or a folder with a name pattern).

    Options: ``startingOffsets`` (``earliest`` or ``latest``) for a stream without a checkpoint, and ``failOnDataLoss``
    (``true``): whether a file that was deleted between its planning and its reading stops the stream.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options)


def tail_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines appended to files as a stream: ``value``, the file's identity in ``source`` and the line's first byte in ``position``."""
    importable(spark)
    spark.dataSource.register(TailLines)
    return spark.readStream.format(FORMAT).options(**options).option("path", path).load()
