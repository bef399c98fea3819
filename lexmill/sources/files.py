"""Files of any place that Arrow's file systems reach: local paths, file://, hdfs://, s3:// and others, and http(s) to read."""

from __future__ import annotations

import fnmatch
import os
import re
import shutil
import time
import urllib.request
import uuid

from pyarrow import fs

TRIES, DELAY = 3, 5.0


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.FileSystem.from_uri(path)) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def _full(path: str, inside: str) -> str:
    """The path as it was given for one that its file system lists."""
    head = re.match(r"[a-z0-9+.-]+://", path)
    if not head or path.startswith("file:"):
        return inside
    host = path[head.end() :].partition("/")[0]
    return f"{head[0]}{inside}" if inside.startswith(host) else f"{head[0]}{host}/{inside.lstrip('/')}"


def found(path: str, pattern: str) -> list[str]:
    """Files below a folder whose name matches, or those that match a path with wildcards, or the file itself, in order."""
    if re.match(r"https?://", path):
        return [path]
    where, inside = place(path)
    if any(c in inside for c in "*?["):
        base = re.split(r"[*?\[]", inside)[0].rpartition("/")[0]
        listed = where.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        return sorted(_full(path, x.path) for x in listed if x.type == fs.FileType.File and fnmatch.fnmatch(x.path, inside))
    info = where.get_file_info(inside)
    if info.type == fs.FileType.File:
        return [_full(path, inside)]
    listed = where.get_file_info(fs.FileSelector(inside, recursive=True, allow_not_found=True))
    return sorted(_full(path, x.path) for x in listed if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, pattern))


def open_stream(path: str, tries: int = TRIES, delay: float = DELAY):
    """A binary stream; failed requests are tried again."""
    if not re.match(r"https?://", path):
        where, inside = place(path)
        return where.open_input_stream(inside, compression=None)
    for left in reversed(range(tries)):
        try:
            return urllib.request.urlopen(path, timeout=60)  # noqa: S310
        except OSError:
            if not left:
                raise
            time.sleep(delay)


def join_files(parts: list[str], path: str) -> None:
    """A file of the bytes of the parts, in their order, that is whole or not there; it streams."""
    where, inside = place(path)
    tmp = f"{inside}.{uuid.uuid4().hex}.tmp"
    with where.open_output_stream(tmp, compression=None) as out:
        for part in parts:
            with open_stream(part) as own:
                shutil.copyfileobj(own, out, 1 << 20)
    where.move(tmp, inside)


def remove_files(files: list[str]) -> None:
    """Files that are gone already are passed over."""
    for file in files:
        where, inside = place(file)
        try:
            where.delete_file(inside)
        except OSError:
            pass


def write_bytes(path: str, data: bytes) -> None:
    """A file that is whole or not there."""
    where, inside = place(path)
    where.create_dir(inside.rpartition("/")[0], recursive=True)
    with where.open_output_stream(inside + ".tmp", compression=None) as out:
        out.write(data)
    where.move(inside + ".tmp", inside)
