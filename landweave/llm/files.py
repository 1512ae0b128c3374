"""Streams on a path that Spark knows: local files directly (memory-mapped on reading), others through pyarrow's file systems."""

from __future__ import annotations

import os
import re

import numpy as np


def local(uri: str) -> str | None:
    """The local path of uri, or None if another file system holds it."""
    if re.match(r"file:/", uri):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def out_stream(uri: str):
    path = local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    where.create_dir(os.path.dirname(path), recursive=True)
    return where.open_output_stream(path)


class Flat:
    """The flat array in a file, read by ranges; on a local or mounted path its pages are mapped, not read."""

    def __init__(self, uri: str, dtype: str):
        self.dtype, self.stream, path = np.dtype(dtype), None, local(uri)
        if path is not None:
            self.mapped = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
            self.size = len(self.mapped)
        else:
            from pyarrow import fs

            where, path = fs.FileSystem.from_uri(uri)
            self.stream = where.open_input_file(path)
            self.size = self.stream.size() // self.dtype.itemsize

    def __len__(self) -> int:
        return self.size

    def part(self, a: int, b: int) -> np.ndarray:
        if self.stream is None:
            return np.asarray(self.mapped[a:b])
        wide = self.dtype.itemsize
        return np.frombuffer(self.stream.read_at((b - a) * wide, a * wide), self.dtype)


def read_folder(uri: str, columns: list[str]) -> dict[str, list]:
    """Columns of the Parquet files in a folder of the shared storage; no folder: no rows."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    path = local(uri)
    where, path = (fs.LocalFileSystem(), path) if path is not None else fs.FileSystem.from_uri(uri)
    out: dict[str, list] = {c: [] for c in columns}
    for f in where.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if f.is_file and f.base_name.endswith(".parquet"):
            with where.open_input_file(f.path) as stream:
                got = pq.ParquetFile(stream).read(columns).to_pydict()
            for c in columns:
                out[c] += got[c]
    return out
