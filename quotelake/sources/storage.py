"""Files of a shared store as Python data sources reach them (through ``pyarrow.fs``)."""

from __future__ import annotations

import re

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` (a URI or a plain local path) and the path inside it."""
    if re.match(r"^file:/+", path):
        path = "/" + re.sub(r"^file:/+", "", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def listed(store: fs.FileSystem, root: str, suffix: str) -> list[fs.FileInfo]:
    """Files below ``root`` with this suffix, by path; nothing whose name or folder starts with ``_`` or ``.``."""
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    hidden = re.compile(r"(^|/)[_.]")
    return sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(suffix)
                   and not hidden.search(f.path[len(root):])), key=lambda f: f.path)
