"""Files that tasks open themselves, on any file system that pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def open_place(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it. An address may be a plain path."""
    if address.startswith("file:"):
        address = "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address)
