"""Files by address, for tasks that read or write parts of them: mounted folders and the stores that Arrow knows."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or folder, and the path there; a path without a scheme is a mounted one."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    store, at = opened(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def names(folder: str) -> list[str]:
    """Names in a folder; none where it isn't there."""
    store, at = opened(folder)
    return sorted(f.base_name for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)))


@contextmanager
def writing(folder: str, name: str):
    """A stream to a file that is there as a whole or not at all."""
    store, at = opened(folder)
    made = f"{at}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(made) as out:
        yield out
    store.move(made, f"{at}/{name}")


def put(folder: str, name: str, parts: Iterable) -> int:
    """Writes a file; its size."""
    size = 0
    with writing(folder, name) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    return size


def blocks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """A file's bytes, a block at a time."""
    store, at = opened(path)
    with store.open_input_stream(at) as f:
        while part := f.read(size):
            yield part


class Ranges:
    """Byte ranges of a file; read counts what was asked of the store."""

    def __init__(self, path: str):
        store, at = opened(path)
        self.file, self.read = store.open_input_file(at), 0
        self.size = self.file.size()

    def __call__(self, at: int, size: int) -> bytes:
        if not 0 <= at <= at + size <= self.size:
            raise ValueError(f"bytes {at} to {at + size} of a file of {self.size}")
        self.read += size
        return self.file.read_at(size, at)

    def close(self) -> None:
        self.file.close()
