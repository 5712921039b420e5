"""Binary files that tasks write to a shared folder: temporary name first, then the final one."""

from __future__ import annotations

import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI (file, hdfs, s3, gs, ...) or of an absolute path."""
    return fs.FileSystem.from_uri(uri)


class Writing:
    """A file written chunk by chunk under a name of this attempt's own; ``close`` moves it to ``uri``.

    Attempts of one task write equal bytes, so the last move to win changes nothing.
    """

    def __init__(self, uri: str):
        self.system, self.path = place(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temporary, self.size = f"{self.path}.{uuid.uuid4().hex}.tmp", 0
        self.out = self.system.open_output_stream(self.temporary, compression=None)

    def write(self, chunk: bytes) -> None:
        self.out.write(chunk)
        self.size += len(chunk)

    def close(self) -> int:
        self.out.close()
        self.system.move(self.temporary, self.path)
        return self.size


def put(uri: str, chunks) -> int:
    """Writes chunks of bytes as one file; its size."""
    out = Writing(uri)
    for chunk in chunks:
        out.write(chunk)
    return out.close()


def get(uri: str) -> bytes:
    system, path = place(uri)
    with system.open_input_stream(path, compression=None) as f:
        return f.read()


def opened(uri: str):
    system, path = place(uri)
    return system.open_input_stream(path, compression=None)
