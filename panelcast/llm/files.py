"""Binary files in the shared folder: written once by tasks, listed and cut into ranges by Spark.

Spark has no sink for binary files, so tasks write them through
``pyarrow.fs``, which opens local and mounted folders, HDFS and object stores
by URI. A file appears under its name only when it is whole: it is written
under a name of the attempt's own and then moved. Content depends on the
task's rows alone, so a task that runs again writes the same file.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as URI or plain path."""
    plain = re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(plain)


def make_folder(uri: str) -> None:
    system, base = open_folder(uri)
    system.create_dir(base, recursive=True)


def write_whole(folder: str, name: str, parts) -> int:
    """Write ``parts`` (bytes) as ``folder/name``; returns the bytes written."""
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)
    own, size = f"{base}/.{name}.{uuid.uuid4().hex}", 0
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    target = f"{base}/{name}"
    if system.get_file_info(target).type == fs.FileType.File:  # an earlier attempt's, with the same content
        system.delete_file(own)
    else:
        system.move(own, target)
    return size


def read_range(path: str, start: int, length: int) -> bytes:
    """Up to ``length`` bytes of a file from ``start``."""
    system, at = open_folder(path)
    with system.open_input_file(at) as f:
        size = f.size()
        return f.read_at(max(0, min(length, size - start)), start) if start < size else b""
