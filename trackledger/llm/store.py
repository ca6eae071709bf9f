"""Files of the shared folder, written and read by tasks.

Spark has no sink for raw bytes, so tasks write archives and token files
through the file system that the folder's address names (file, hdfs, s3, gs).
Every attempt of a task writes files of its own; the manifest, a table that
Spark commits, names those that count. A lost executor or a second attempt
leaves at most files that no manifest names.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an address; a bare path is a local one."""
    return pafs.FileSystem.from_uri(uri)


class Folder:
    """Opens new files below ``uri``, named by partition and attempt."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")
        self.system, self.path = file_system(self.uri)
        self.system.create_dir(self.path, recursive=True)

    def new(self, suffix: str):
        """(address, open stream) of a file that no other attempt writes."""
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
        return f"{self.uri}/{name}", self.system.open_output_stream(f"{self.path}/{name}", compression=None)


def open_input(uri: str):
    """A file to read at any position."""
    system, path = file_system(uri)
    return system.open_input_file(path)
