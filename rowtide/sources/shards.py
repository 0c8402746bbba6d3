"""Sharded change log as a streaming source: a partition and an offset per shard, from the latest or the earliest record.

A log is a folder with one folder per shard, ``shard=<name>``; in it stand append-only files of lines whose relative names
sort in the order of writing (``000001.log``, ``segment=000002/part-…``). Files and folders that begin with ``_`` or ``.``
are passed over. A record is a line, read as bytes; an empty line is none. The newest file of a shard may still grow, so only
its complete lines are read; an older one is finished, and a last line without a line end counts.

The offset of a shard is ``[file, bytes]``: what lies behind is read, and a file that has been read may be deleted. A shard
that appears later is read from its first record. Where a stream begins is written beside its checkpoint once, before the
first batch, because Spark asks again if the stream stops before that batch is planned. A shard whose file has become shorter
than what was read of it raises.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rowtide.files import qualified
from rowtide.operators.events import decode

FORMAT = "shard_log"
LATEST, EARLIEST = "latest", "earliest"
PREFIX = "shard="
#: A shard's new bytes are dealt to tasks in pieces of this size, so that one busy shard is not one task.
SPLIT = 64 << 20
BLOCK = 1 << 20
LISTERS = 16
SCHEMA = "shard string, file string, position long, value binary"

Place = tuple[str, int]
#: Before the first byte of any file.
FIRST: Place = ("", 0)


@dataclass
class Piece:
    """Bytes ``[begin, end)`` of a file; ``fresh`` if a record begins at ``begin``."""

    file: str
    path: str
    begin: int
    end: int
    fresh: bool


@dataclass
class Share(InputPartition):
    """What one task reads: pieces of a shard in a row."""

    shard: str
    pieces: list[Piece]


def shares(shard: str, pieces: list[Piece], limit: int) -> list[Share]:
    """The pieces in order, put together to tasks of up to ``limit`` bytes or one piece."""
    out, filled = [], limit
    for piece in pieces:
        size = piece.end - piece.begin
        if filled + size > limit:
            out.append(Share(shard, []))
            filled = 0
        out[-1].pieces.append(piece)
        filled += size
    return out


def _hidden(name: str) -> bool:
    return any(part.startswith(("_", ".")) for part in name.split("/"))


def last_line_end(store: fs.FileSystem, path: str, begin: int, end: int, block: int = BLOCK) -> int:
    """The place behind the last line end in ``[begin, end)``; ``begin`` if there is none."""
    with store.open_input_file(path) as source:
        while end > begin:
            a = max(begin, end - block)
            at = source.read_at(end - a, a).rfind(b"\n")
            if at >= 0:
                return a + at + 1
            end = a
    return begin


def lines(store: fs.FileSystem, path: str, begin: int, end: int, fresh: bool, block: int = BLOCK) -> Iterator[list[tuple[int, bytes]]]:
    """Position and bytes of the lines that begin in ``[begin, end)``, some at a time; the last one is read to its end."""
    with store.open_input_file(path) as source:
        size, at, rest, start = source.size(), begin, [], begin
        if not fresh:
            # The line that holds the byte before belongs to the piece before.
            at = start = begin - 1
        skip = not fresh
        while at < size and start < end:
            data = source.read_at(min(block, size - at), at)
            at += len(data)
            *whole, tail = data.split(b"\n")
            found = []
            for part in whole:
                line = b"".join([*rest, part]) if rest else part
                rest = []
                if skip:
                    skip = False
                elif line and start < end:
                    found.append((start, line))
                start += len(line) + 1
            if tail:
                rest.append(tail)
            if found:
                yield found
        if rest and not skip and start < end and at >= size:
            yield [(start, b"".join(rest))]


class ShardReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.begun, self.start = options["path"], options["begun"], options.get("start", LATEST)
        self.split = int(options.get("splitbytes", SPLIT))
        if self.start not in (LATEST, EARLIEST):
            raise ValueError(f"start is {LATEST} or {EARLIEST}, not {self.start!r}")
        self.ends: dict[str, tuple[str, int, int]] = {}

    def _store(self, uri: str) -> tuple[fs.FileSystem, str]:
        scheme, colon, rest = uri.partition(":")
        return fs.FileSystem.from_uri(f"{scheme}://{rest}" if colon and not rest.startswith("//") else uri)

    def _files(self, store: fs.FileSystem, folder: str) -> list[tuple[str, int]]:
        """Relative names and sizes of a shard's files, in order."""
        found = store.get_file_info(fs.FileSelector(folder, recursive=True))
        names = [(f.path[len(folder) :].strip("/"), f.size) for f in found if f.type == fs.FileType.File]
        return sorted(x for x in names if not _hidden(x[0]))

    def _shards(self, store: fs.FileSystem, root: str) -> dict[str, list[tuple[str, int]]]:
        """Files of all shards; the folders are listed side by side."""
        tops = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        folders = sorted(t.path for t in tops if t.type == fs.FileType.Directory and t.base_name.startswith(PREFIX))
        with ThreadPoolExecutor(LISTERS) as pool:
            every = pool.map(lambda folder: self._files(store, folder), folders)
        return {folder.rsplit("/", 1)[-1][len(PREFIX) :]: files for folder, files in zip(folders, every)}

    def _end(self, store: fs.FileSystem, root: str, shard: str, files: list[tuple[str, int]]) -> tuple[str, int, int]:
        """A shard's newest file, its size and the place behind its last complete line; only bytes not looked at are read."""
        if not files:
            return "", 0, 0
        name, size = files[-1]
        before, seen, end = self.ends.get(shard, ("", 0, 0))
        if before != name:
            seen = end = 0
        if size < seen:
            raise ValueError(f"{shard}/{name} has become shorter")
        found = last_line_end(store, f"{root}/{PREFIX}{shard}/{name}", seen, size) if size > seen else seen
        return name, size, found if found > seen else end

    def initialOffset(self) -> dict:
        store, path = self._store(self.begun)
        if store.get_file_info(path).type == fs.FileType.File:
            with store.open_input_file(path) as source:
                return json.loads(source.read())
        begin = self.latestOffset() if self.start == LATEST else {}
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(path + ".draft") as out:
            out.write(json.dumps(begin).encode())
        store.move(path + ".draft", path)
        return begin

    def latestOffset(self) -> dict:
        store, root = self._store(self.root)
        shards = self._shards(store, root)
        with ThreadPoolExecutor(LISTERS) as pool:
            self.ends = dict(zip(shards, pool.map(lambda item: self._end(store, root, *item), shards.items())))
        return {shard: [name, end] for shard, (name, _, end) in self.ends.items() if name}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, root = self._store(self.root)
        shards = self._shards(store, root)
        tasks = []
        for shard, (last, stop) in sorted(end.items()):
            name, done = start.get(shard, FIRST)
            sizes = dict(shards.get(shard, []))
            unread = last if (name, done) < (last, stop) else None
            if unread and (sizes.get(last, -1) < stop or name in sizes and sizes[name] < done):
                raise ValueError(f"{shard}: {last} or {name} is gone or has become shorter than what was read")
            pieces = []
            for file, size in sizes.items():
                if name <= file <= last and unread:
                    a, b = (done if file == name else 0), (stop if file == last else size)
                    pieces += [
                        Piece(file, f"{root}/{PREFIX}{shard}/{file}", at, min(at + self.split, b), at == a)
                        for at in range(a, b, self.split)
                    ]
            tasks += shares(shard, pieces, self.split)
        return tasks or [Share("", [])]

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        store, _ = self._store(self.root)
        for piece in share.pieces:
            for found in lines(store, piece.path, piece.begin, piece.end, piece.fresh):
                at, value = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([share.shard] * len(at)), pa.array([piece.file] * len(at)), pa.array(at, pa.int64()), pa.array(value, pa.binary())],
                    names=["shard", "file", "position", "value"],
                )


class ShardLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ShardReader:
        return ShardReader({k.lower(): v for k, v in self.options.items()})


def shard_stream(
    spark: SparkSession, path: str, checkpoint: str, start: str = LATEST, split_bytes: int = SPLIT, where: bool = False
) -> DataFrame:
    """Streaming frame with the text ``value`` of each record; ``where`` adds ``shard``, ``file`` and ``position``.

    ``checkpoint`` is that of the query the frame goes into; the places where it began are kept there.
    """
    spark.dataSource.register(ShardLog)
    raw = (
        spark.readStream.format(FORMAT)
        .option("begun", f"{qualified(spark, checkpoint)}/shards-begun.json")
        .option("start", start)
        .option("splitBytes", str(split_bytes))
        .load(qualified(spark, path))
    )
    return decode(raw if where else raw.select("value"), "value")
