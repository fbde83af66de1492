"""File systems of paths, for what tasks or the driver do with single files and folders."""

from __future__ import annotations

import re
from functools import lru_cache

from pyarrow.fs import FileSystem

# Schemes that the two file systems in use name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


@lru_cache(maxsize=16)
def _file_system(start: str) -> FileSystem:
    if start.startswith("/"):
        return FileSystem.from_uri("file:///")[0]
    return FileSystem.from_uri(start)[0]


def place(path: str) -> tuple[FileSystem, str, str]:
    """File system, path inside it, and what to put before that for the path's full name."""
    path = re.sub("^file:/+", "/", path)
    if path.startswith("/"):
        return _file_system("/"), path, ""
    scheme, _, rest = path.partition("://")
    host = rest.partition("/")[0]
    known = SCHEMES.get(scheme, scheme)
    if known in ("hdfs", "viewfs"):
        return _file_system(f"{known}://{host}"), rest[len(host) :], f"{scheme}://{host}"
    return _file_system(f"{known}://{host}"), rest, f"{scheme}://"
