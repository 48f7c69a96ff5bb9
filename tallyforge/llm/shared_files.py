"""Binary files in the shared folder, written and range-read by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; a path without scheme is local."""
    return fs.FileSystem.from_uri(uri)


def fresh_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task uses; what is not in a manifest is never read."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def open_random(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)
