"""Files in the shared folder, read and written by tasks: any store that has a pyarrow file system."""

from __future__ import annotations

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it. s3a:// and s3n:// are read as s3://."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    for old in ("s3a://", "s3n://"):
        if uri.startswith(old):
            uri = "s3://" + uri[len(old) :]
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """An output stream to a new file; missing folders are made."""
    store, path = resolve(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def open_read(uri: str):
    """A file for random reads."""
    store, path = resolve(uri)
    return store.open_input_file(path)


def read(uri: str) -> bytes:
    with open_read(uri) as f:
        return f.read()
