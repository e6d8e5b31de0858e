"""Writing and reading binary files of tasks, on any store that Arrow can open."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri.removeprefix("file:")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def make_dir(uri: str) -> None:
    store, path = _at(uri)
    store.create_dir(path, recursive=True)


@contextmanager
def new_file(uri: str):
    """A stream to a file that appears whole or not at all: it is written under
    another name and renamed, so a second attempt of a task only replaces it."""
    store, path = _at(uri)
    other = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(other) as out:
            yield out
        store.move(other, path)
    except BaseException:
        if store.get_file_info(other).type != fs.FileType.NotFound:
            store.delete_file(other)
        raise


def open_file(uri: str):
    """A file with random access."""
    store, path = _at(uri)
    return store.open_input_file(path)


def read_file(uri: str) -> bytes:
    with open_file(uri) as f:
        return f.read()
