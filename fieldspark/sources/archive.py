"""Answers of a service that were kept as JSON lines in a folder, asked for as the service is: a file a page, or rows by offset
and limit. The key is the folder's URI."""

from __future__ import annotations

import json

from pyarrow.fs import FileSelector, FileSystem

from fieldspark.sources import rest

LIMIT = 1_000


def _files(key: str):
    fs, path = FileSystem.from_uri(key)
    return fs, sorted(f.path for f in fs.get_file_info(FileSelector(path)) if f.path.endswith(".json"))


def _lines(fs, file: str) -> list[bytes]:
    with fs.open_input_stream(file) as f:
        return f.read().splitlines()


def page_of_folder(key: str, page: int):
    """The objects of a folder's ``page``-th file, and whether another follows; a folder without files is one empty page."""
    fs, files = _files(key)
    return [json.loads(line) for line in _lines(fs, files[page])] if files else [], page + 1 < len(files)


def _rows(key: str, offset: int, limit: int):
    """The objects from ``offset`` on, over all files, and how many there are; only their files' lines are held."""
    fs, files = _files(key)
    found, total = [], 0
    for file in files:
        lines = _lines(fs, file)
        found += lines[max(0, offset - total) : max(0, offset + limit - total)]
        total += len(lines)
    return [json.loads(line) for line in found], total


rows_of_folder = rest.by_offset(_rows, LIMIT)
