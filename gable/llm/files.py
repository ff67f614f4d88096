"""Binary files in the shared folder, written and read from Spark tasks.

Paths are URIs of the folder named by ``spark.checkpoint.dir`` (file, hdfs,
s3 and gs go through pyarrow's file systems). A file appears under its name
only when complete: it is written beside it and renamed, so a retried or
speculative task leaves the same file once.
"""

from __future__ import annotations

import contextlib
import posixpath
import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(uri: str):
    """Open ``uri`` for writing; the name exists only after a clean exit."""
    system, path = locate(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, path)


@contextlib.contextmanager
def reading(uri: str):
    system, path = locate(uri)
    with system.open_input_file(path) as src:
        yield src
