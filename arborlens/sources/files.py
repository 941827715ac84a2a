"""Files that tasks open themselves, in pieces: by path or address of any store that pyarrow's file systems know.

The folder must be one that the driver and all executors see.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import InputPartition, WriterCommitMessage


@dataclass
class Piece(InputPartition):
    """Piece ``part`` of ``parts`` of a file; rank: the file's place among all by path."""

    rank: int
    path: str
    part: int
    parts: int


@dataclass
class Counted(WriterCommitMessage):
    """A part that a task wrote."""

    part: int
    rows: int
    name: str = ""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def address(path: str, like: str) -> str:
    """A path in the store of ``like``, written as Spark does."""
    scheme = like.partition("://")[0] if "://" in like else "file"
    return f"file:{path}" if scheme == "file" else f"{scheme}://{path}"


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """Addresses and sizes of the files below a path, or of the one it names, in order of their addresses."""
    store, where = opened(path)
    info = store.get_file_info(where)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(where, recursive=True))
    return sorted((address(f.path, path), f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def pieces(path: str, suffix: str, piece_bytes: int) -> list[Piece]:
    """All files below the path in pieces of at most about piece_bytes. Only names and sizes are read here."""
    out = []
    for rank, (file, size) in enumerate(listed(path, suffix)):
        n = max(1, -(-size // piece_bytes))
        out += [Piece(rank, file, i, n) for i in range(n)]
    return out


def local_path(path: str) -> str | None:
    """The path in a mounted file system, or None for another store."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else os.path.abspath(path)
