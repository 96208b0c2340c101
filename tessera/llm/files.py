"""Binary files in the shared folder, written so that a lost or repeated task does no harm.

A task writes a file of its own name and reports it in a row; only reported files are read. Names never
repeat, so no file is written twice; a file without content is a file like others.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyarrow import fs


def locate(uri: str) -> tuple[Any, str]:
    """File system and path of a URI (file, hdfs, s3, gs, ...) or of a plain path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, stem: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}"


def create(uri: str) -> Any:
    store, path = locate(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)  # by default a name in .gz is packed again


def open_input(uri: str) -> Any:
    store, path = locate(uri)
    return store.open_input_file(path)
