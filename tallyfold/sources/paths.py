"""Files by path or URI, for Python readers and writers."""

from __future__ import annotations

import fnmatch
import posixpath
import re

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


def matching(path: str, suffix: str) -> list[fs.FileInfo]:
    """The file, those of the folder that end in ``suffix``, or those that fit a pattern in the last place of the path; by name."""
    folder, pattern = posixpath.split(path)
    if re.search(r"[*?\[]", pattern):
        system, root = at(folder or ".")
        found = [f for f in system.get_file_info(fs.FileSelector(root)) if f.is_file and fnmatch.fnmatchcase(f.base_name, pattern)]
    else:
        system, root = at(path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(root)) if f.is_file and f.base_name.endswith(suffix)]
    return sorted(found, key=lambda f: f.path)
