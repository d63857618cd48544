"""Files that tasks write into, and read from, the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI (file, hdfs, s3, gs, abfs; a bare path is local) and the path in it."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_whole(folder: str, name: str, attempt: str, write: Callable[[BinaryIO], None]) -> int:
    """Write a file under a name of this attempt and move it to ``name``: readers see all of it or nothing,
    and a task that runs again replaces its own file by the same bytes. Returns its size."""
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    temporary = f"{path}/.{name}.{attempt}"
    with system.open_output_stream(temporary, compression=None) as out:
        write(out)
        size = out.tell()
    system.move(temporary, f"{path}/{name}")
    return size


def open_file(folder: str, name: str):
    system, path = filesystem(folder)
    return system.open_input_file(f"{path}/{name}")
