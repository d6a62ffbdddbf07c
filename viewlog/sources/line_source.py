"""Log lines by byte range: a Python data source (S1, S2, section 2.11).

Every partition is a byte range of one file, read where it lies; the text is
copied nowhere. A range holds the records that start in it, so ranges may be cut
anywhere. Three uses:

* ``index``: counts the lines of each range and marks where every
  ``MARK_LINES``-th of them starts (the sparse line index);
* ``lines``: the lines of given ranges with their row numbers, from a mark on;
* as a stream: the bytes that files have gained, up to their last line end.

Records end at ``\\n``; a carriage return ends a line too. Lines of blanks only
are no lines. Files with a compression suffix are one range each.

This module goes to the workers by value, so that they need not have the package
installed; it imports nothing of it.
"""

from __future__ import annotations

import json
import urllib.parse
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Lines between two marks of the index, bytes of a range, and bytes read at a time.
MARK_LINES = 4096
RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
BATCH_LINES = 8192

LINES = "value binary, source_file string, row_index bigint"
INDEX = "source_file string, part int, uri string, start bigint, stop bigint, lines bigint, marks array<struct<line: bigint, at: bigint>>"
STREAM = "value binary, source_file string, uri string, start bigint, stop bigint, line bigint"
_BOM = b"\xef\xbb\xbf"
_PACKED = (".gz", ".bz2", ".zst", ".deflate")
_END = 1 << 62


@dataclass
class Range(InputPartition):
    uri: str
    source_file: str
    part: int = 0  # place of the file among the parts of its source file
    start: int = 0  # records that start from here
    stop: int = _END  # and before here
    first: bool = False  # ``start`` is known to be a record's first byte
    row: int = 0  # row number of the first line
    skip: int = 0  # lines to leave out at the start
    take: int = _END  # lines to give


def packed(uri: str) -> bool:
    return uri.endswith(_PACKED)


def local_path(uri: str) -> str | None:
    """The path of a local file's URI, else None."""
    parts = urllib.parse.urlsplit(uri)
    return urllib.parse.unquote(parts.path) if parts.scheme in ("", "file") else None


def file_system(uri: str):
    """The Arrow file system of a URI and the path in it."""
    from pyarrow import fs

    path = local_path(uri)
    if path is not None:
        return fs.LocalFileSystem(), path
    for hadoop in ("s3a://", "s3n://"):
        if uri.startswith(hadoop):
            uri = "s3://" + uri[len(hadoop) :]
    return fs.FileSystem.from_uri(uri)


class _Inflated:
    """A raw zlib stream (``.deflate``) as a file."""

    def __init__(self, f) -> None:
        self.f, self.z = f, zlib.decompressobj()

    def read(self, n: int) -> bytes:
        out = b""
        while not out and not self.z.eof:
            data = self.f.read(n)
            if not data:
                return self.z.flush()
            out = self.z.decompress(data)
        return out


def _open(uri: str):
    system, path = file_system(uri)
    if uri.endswith(".deflate"):
        return _Inflated(system.open_input_stream(path, compression=None))
    return system.open_input_stream(path) if packed(uri) else system.open_input_file(path)


def first_record(f, start: int, stop: int) -> int:
    """Where the first record at or after ``start`` begins (``stop`` if none begins before it)."""
    if start == 0:
        return 0
    f.seek(start - 1)
    at = start - 1
    while at < stop:
        data = f.read(BLOCK_BYTES)
        if not data:
            return stop
        end = data.find(b"\n")
        if end >= 0:
            return min(at + end + 1, stop)
        at += len(data)
    return stop


def blocks(f, at: int, stop: int, seekable: bool = True) -> Iterator[tuple[int, bytes]]:
    """(place, bytes): whole records that start in [at, stop); ``at`` is a record's first byte."""
    if seekable:
        f.seek(at)
    held: list[bytes] = []
    size = 0
    while at < stop:
        data = f.read(BLOCK_BYTES)
        end = data.rfind(b"\n") + 1
        if data and not end:  # a record longer than a block
            held.append(data)
            size += len(data)
            continue
        whole = b"".join([*held, data])
        cut = size + end if data else len(whole)
        if at + cut >= stop:
            inside = whole.find(b"\n", stop - at - 1) + 1
            yield at, whole[: inside or len(whole)]
            return
        if not data:
            if whole:
                yield at, whole
            return
        yield at, whole[:cut]
        at += cut
        held, size = [whole[cut:]], len(whole) - cut


def split_lines(data: bytes, at: int) -> Iterator[tuple[int, bytes]]:
    """(place of its record, line) for every line that is not blank."""
    returns = b"\r" in data
    for record in data.split(b"\n"):
        text = record[len(_BOM) :] if at == 0 and record.startswith(_BOM) else record
        for line in text.split(b"\r") if returns else (text,):
            if line.strip(b" "):
                yield at, line
        at += len(record) + 1


def read_range(r: Range) -> Iterator[tuple[int, bytes]]:
    f = _open(r.uri)
    whole = packed(r.uri)
    start = r.start if r.first or whole else first_record(f, r.start, r.stop)
    for at, data in blocks(f, start, r.stop, not whole):
        yield from split_lines(data, at)


def batches(rows: Iterator[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_LINES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def cut_ranges(uri: str, source_file: str, part: int, size: int, range_bytes: int, start: int = 0) -> list[Range]:
    """[start, size) of a file in ranges of ``range_bytes``."""
    if packed(uri):
        return [Range(uri, source_file, part, 0, _END)]
    return [Range(uri, source_file, part, a, min(a + range_bytes, size)) for a in range(start, size, range_bytes)]


@dataclass
class Ranges(InputPartition):
    """What one task reads: a range, or several small ones."""

    items: list[Range]


def dealt(ranges: Sequence[Range], tasks: int) -> list[Ranges]:
    """The ranges in order, small ones together, in about ``tasks`` partitions or more."""
    sizes = [min(r.stop - r.start, RANGE_BYTES) for r in ranges]
    target = min(RANGE_BYTES, max(1, sum(sizes) // max(tasks, 1)))
    out: list[Ranges] = []
    held = target
    for r, size in zip(ranges, sizes, strict=True):
        if held + size > target:
            out.append(Ranges([]))
            held = 0
        out[-1].items.append(r)
        held += size
    return out


class _Reader(DataSourceReader):
    def __init__(self, ranges: list[Range], tasks: int) -> None:
        self.ranges, self.tasks = ranges, tasks

    def partitions(self) -> list[Ranges]:
        return dealt(self.ranges, self.tasks)


class _LineReader(_Reader):
    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for r in partition.items:
                for k, (_, line) in enumerate(read_range(r)):
                    if k >= r.skip + r.take:
                        break
                    if k >= r.skip:
                        yield line, r.source_file, r.row + k - r.skip

        return batches(rows(), ["value", "source_file", "row_index"], [pa.binary(), pa.string(), pa.int64()])


class _IndexReader(_Reader):
    def __init__(self, ranges: list[Range], tasks: int, mark_lines: int) -> None:
        super().__init__(ranges, tasks)
        self.mark_lines = mark_lines

    def read(self, partition: Ranges) -> Iterator[tuple]:
        for r in partition.items:
            lines, due, last, marks = 0, 0, -1, []
            for at, _ in read_range(r):
                if lines >= due and at != last and not packed(r.uri):
                    marks.append((lines, at))
                    due = lines - lines % self.mark_lines + self.mark_lines
                lines, last = lines + 1, at
            yield (r.source_file, r.part, r.uri, r.start, r.stop, lines, marks)


class LineStream(DataSourceStreamReader):
    """Stream position: the bytes of each file given so far, always a line end.

    A trigger takes at most ``max_bytes`` (at least one range). Positions are
    learnt from what Spark asks for; after a restart ``known`` holds them.
    """

    def __init__(self, root: str, range_bytes: int, max_bytes: int, known: dict[str, int]) -> None:
        self.root, self.range_bytes, self.max_bytes = root, range_bytes, max_bytes
        self.at = dict(known)

    def initialOffset(self) -> dict:
        return {}

    def _listed(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        system, path = file_system(self.root)
        found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        base = self.root.rstrip("/")
        out = []
        for info in found:
            below = info.path[len(path.rstrip("/")) :].lstrip("/")
            hidden = any(x.startswith((".", "_")) and "=" not in x for x in below.split("/"))
            if info.type == fs.FileType.File and not hidden:
                out.append((f"{base}/{urllib.parse.quote(below)}", info.size))
        return sorted(out)

    def _complete(self, uri: str, size: int, since: int) -> int:
        """The end of the last whole line in [since, size); a compressed file is whole."""
        if packed(uri):
            return size
        with _open(uri) as f:
            end = size
            while end > since:
                start = max(since, end - BLOCK_BYTES)
                f.seek(start)
                cut = f.read(end - start).rfind(b"\n")
                if cut >= 0:
                    return start + cut + 1
                end = start
        return since

    def latestOffset(self) -> dict:
        out, left = dict(self.at), self.max_bytes
        for uri, size in self._listed():
            since = out.get(uri, 0)
            if size <= since or left <= 0:
                continue
            limit = since + max(left, self.range_bytes)
            stop = size if packed(uri) else self._complete(uri, min(size, limit), since)
            if stop == since and size > limit:  # one very long line
                stop = self._complete(uri, size, since)
            if stop > since:
                out[uri] = stop
                # The parts of a source file are taken in order: none before the one ahead of it is done.
                left = 0 if size > limit and not packed(uri) else left - (stop - since)
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at.update(end)
        out = []
        for uri, stop in sorted(end.items()):
            since = start.get(uri, 0)
            if stop > since:
                ranges = cut_ranges(uri, source_name(uri, self.root), 0, stop, self.range_bytes, since)
                ranges[0].first = True
                out += ranges
        return out

    def commit(self, end: dict) -> None:
        self.at.update(end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        p = partition
        rows = ((line, p.source_file, p.uri, p.start, p.stop, k) for k, (_, line) in enumerate(read_range(p)))
        names = ["value", "source_file", "uri", "start", "stop", "line"]
        return batches(rows, names, [pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()])


def source_name(uri: str, root: str) -> str:
    """The source file that a path belongs to: its ``source_file=`` folder, else its name without suffixes."""
    below = urllib.parse.unquote(uri[len(root.rstrip("/")) :].lstrip("/"))
    for folder in below.split("/")[:-1]:
        if folder.startswith("source_file="):
            return urllib.parse.unquote(folder.split("=", 1)[1])
    name = below.rsplit("/", 1)[-1]
    for ends in (_PACKED, (".json", ".jsonl")):
        name = next((name[: -len(e)] for e in ends if name.endswith(e)), name)
    return name


class LogLines(DataSource):
    """Options: ``mode`` (index or lines), ``ranges`` (JSON) and ``tasks``, or for a stream ``path``."""

    @classmethod
    def name(cls) -> str:
        return "viewlog_lines"

    def schema(self) -> str:
        return {"index": INDEX, "lines": LINES}.get(self.options.get("mode", ""), STREAM)

    def _number(self, name: str, default: int) -> int:
        return int(self.options.get(name, default))

    def reader(self, schema) -> DataSourceReader:
        ranges = [Range(*r) for r in json.loads(self.options["ranges"])]
        if self.options["mode"] == "index":
            return _IndexReader(ranges, self._number("tasks", 1), self._number("mark_lines", MARK_LINES))
        return _LineReader(ranges, self._number("tasks", 1))

    def streamReader(self, schema) -> DataSourceStreamReader:
        size = self._number("range_bytes", RANGE_BYTES)
        return LineStream(self.options["path"], size, self._number("max_bytes", 16 * size), json.loads(self.options.get("known", "{}")))
