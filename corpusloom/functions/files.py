"""Small file helpers used inside tasks; paths may be plain or URIs on shared storage."""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyarrow import fs


# Store names that differ between Hadoop and Arrow.
_ALIASES = {"s3a": "s3", "s3n": "s3"}


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a plain path, a ``file:`` URI or a store URI; an unknown store raises."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(path[5:]).lstrip("/")
    if found := re.match(r"^([a-zA-Z][\w+.-]*)://", path):
        scheme = found[1].lower()
        return fs.FileSystem.from_uri(_ALIASES.get(scheme, scheme) + path[len(found[1]):])
    return fs.LocalFileSystem(), path


def write_bytes(path: str, payload: bytes) -> None:
    """Write one small file."""
    store, inner = resolve(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(inner) as out:
        out.write(payload)


def range_sha1(path: str, start: int, size: int) -> str | None:
    """SHA-1 of up to ``size`` bytes from a place of a file, a piece at a time; ``None`` if it cannot be read."""
    digest = hashlib.sha1()
    try:
        store, inner = resolve(path)
        with store.open_input_file(inner) as file:
            file.seek(start)
            while size > 0 and (piece := file.read(min(size, 1 << 20))):
                digest.update(piece)
                size -= len(piece)
    except OSError:
        return None
    return digest.hexdigest()
