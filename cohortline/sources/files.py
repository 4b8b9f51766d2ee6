"""Whole files by path, from tasks and from the driver."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyarrow import fs
from pyspark import TaskContext


def system_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path)
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def put_file(path: str, data: list[bytes]) -> None:
    """Write a file under its name in one move, so that a repeated task leaves a whole file."""
    system, place = system_of(path)
    context = TaskContext.get()
    folder, name = place.rsplit("/", 1)
    # A name that listings pass over, and that no other attempt uses.
    own = f"{folder}/_{name}.{context.taskAttemptId() if context else 'driver'}"
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(own) as out:
        for piece in data:
            out.write(piece)
    system.move(own, place)


def get_file(path: str, start: int = 0, size: int | None = None) -> bytes:
    system, place = system_of(path)
    with system.open_input_file(place) as source:
        source.seek(start)
        return source.read(source.size() - start if size is None else size)


def list_files(path: str) -> list[tuple[str, int]]:
    """Paths below a folder with their sizes, in order; names that begin with ``_`` or ``.`` are left out."""
    system, place = system_of(path)
    found = system.get_file_info(fs.FileSelector(place, recursive=True))
    return sorted((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "_.")
