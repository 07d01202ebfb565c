"""Very large files in byte ranges: tasks that each read their own part of a file, where ``binaryFile`` makes it one row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a row at most.
PIECE = 1 << 20


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class RangeReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        self.size = int(options.get("rangebytes", options.get("rangeBytes", str(64 << 20))))
        self.lines = options.get("lines", "false").lower() == "true"

    def partitions(self) -> list[Range]:
        from pyarrow.fs import FileSelector, FileSystem, FileType

        out = []
        for uri in self.paths:
            fs, path = FileSystem.from_uri(uri)
            info = fs.get_file_info(path)
            files = [info] if info.type == FileType.File else [f for f in fs.get_file_info(FileSelector(path, recursive=True)) if f.type == FileType.File and not f.base_name.startswith((".", "_"))]
            base = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
            out += [Range(base + f.path, k, min(k + self.size, f.size)) for f in files for k in range(0, f.size, self.size)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(partition.path)
        with fs.open_input_file(path) as f:
            if not self.lines:
                for at in range(partition.start, partition.end, PIECE):
                    yield partition.path, at, bytes(f.read_at(min(PIECE, partition.end - at), at))
                return
            yield from ((partition.path, at, line) for at, line in lines_of(f, partition.start, partition.end))


def lines_of(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(where it begins, line without its line feed) of the lines that begin in a range; the last one is read to its end."""
    at = start
    if start:  # the line that goes on here is the range's before, unless one has just ended
        at = start - 1
        while True:
            piece = f.read_at(PIECE, at)
            if not piece:
                return
            cut = piece.find(b"\n")
            if cut >= 0:
                at += cut + 1
                break
            at += len(piece)
            if at >= end:
                return
    held, begin = b"", at
    while begin < end:
        piece = f.read_at(PIECE, at)
        at += len(piece)
        parts = (held + piece).split(b"\n")
        held = parts.pop()
        for line in parts:
            if begin >= end:
                return
            yield begin, line
            begin += len(line) + 1
        if not piece:
            if held and begin < end:
                yield begin, held
            return


class ByteRanges(DataSource):
    """``spark.read.format("byte_ranges")``: (path, at, content) of files or folders in ``paths``, in pieces of up to a megabyte or,
    with ``lines``, line by line, however long the file; a task reads one range of ``rangeBytes`` (and the rest of a last line)."""

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "path string, at long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return RangeReader(self.options)
