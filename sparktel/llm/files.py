"""Opening files in the shared folder from executors, whatever file system it is on."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlsplit

import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is local."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), unquote(urlsplit(uri).path) if uri.startswith("file:") else uri
    return pafs.FileSystem.from_uri(uri)


def join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def attempt_name(stem: str, suffix: str) -> str:
    """A name no other attempt of the task uses: only files that a finished attempt reports are ever read."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    fs, path = locate(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_random(uri: str):
    fs, path = locate(uri)
    return fs.open_input_file(path)


def open_stream(uri: str):
    fs, path = locate(uri)
    return fs.open_input_stream(path, compression=None, buffer_size=1 << 20)


def delete(uri: str) -> None:
    fs, path = locate(uri)
    fs.delete_file(path)
