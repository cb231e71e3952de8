"""Files in the shared folder, opened by URI from any task; a file appears under its name only when whole."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))  # Hadoop's names of that store


@contextmanager
def written(uri: str, attempt: int) -> Iterator[pa.NativeFile]:
    """A stream to uri: bytes go to a name of this attempt's own, which replaces uri at the end."""
    system, path = locate(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{attempt}.tmp"
    with system.open_output_stream(own) as out:
        yield out
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(path)
    system.move(own, path)


def opened(uri: str) -> pa.NativeFile:
    system, path = locate(uri)
    return system.open_input_file(path)
