"""Whole files by URI, on whatever file system."""

from __future__ import annotations

import os

import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is local."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def read_bytes(uri: str) -> bytes:
    fs, path = locate(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def write_bytes(uri: str, raw: bytes) -> None:
    fs, path = locate(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path, compression=None) as f:
        f.write(raw)
