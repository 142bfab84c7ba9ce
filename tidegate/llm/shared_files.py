"""Files that tasks write and read in the shared work folder.

Tasks use Arrow's file systems, so any folder that Arrow reaches will do. A file is written under a
name of its own attempt and then moved, so a task that is run again or twice at once
leaves one whole file.
"""

from __future__ import annotations

import contextlib
import uuid

import pyarrow.fs as pafs


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


@contextlib.contextmanager
def whole_file(folder: str, name: str):
    """An output stream; the file has its name only once it is complete."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    attempt = f"{base}/_{name}-{uuid.uuid4().hex}"
    stream = fs.open_output_stream(attempt)
    try:
        yield stream
    except BaseException:
        stream.close()
        fs.delete_file(attempt)
        raise
    stream.close()
    fs.move(attempt, f"{base}/{name}")
