"""Files in the folder that driver and executors share. A writer's file has a name of its own; it counts once a table that Spark committed names it,
so a task that ran twice leaves a file that nothing reads, and a lost executor takes nothing with it."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, stem: str, ending: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{ending}"


@contextmanager
def writing(uri: str):
    where, path = place(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path, compression=None, buffer_size=1 << 20) as out:
        yield out


def read_all(uri: str) -> bytes:
    where, path = place(uri)
    with where.open_input_stream(path, compression=None) as f:
        return f.read()


def opened(uri: str):
    """For reads at any place."""
    where, path = place(uri)
    return where.open_input_file(path)
