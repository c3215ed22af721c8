"""Files beside Spark's own readers and writers, by URI, from the driver and from executors."""

from __future__ import annotations


def filesystem(uri: str):
    """(file system, path) of a URI; a local path stands for itself."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def read(uri: str, name: str) -> bytes | None:
    """A small file of a folder, null where it is missing."""
    system, path = filesystem(uri)
    try:
        with system.open_input_file(f"{path}/{name}") as f:
            return f.read()
    except FileNotFoundError:
        return None


def put(uri: str, name: str, content: bytes) -> None:
    """Writes a small file whole or not at all: under another name first, which then takes the place of the old one."""
    import uuid

    system, path = filesystem(uri)
    other = f"{path}/_{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(other) as f:
        f.write(content)
    system.move(other, f"{path}/{name}")


def delete(uri: str, names: list[str]) -> None:
    """Deletes files of a folder, those of them that are there."""
    system, path = filesystem(uri)
    for name in names:
        try:
            system.delete_file(f"{path}/{name}")
        except FileNotFoundError:
            pass
