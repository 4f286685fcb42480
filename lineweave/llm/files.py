"""Binary files in the shared folder, from tasks: whole writes by rename, and range reads."""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs


class Store:
    """Files under a URI (``file:``, ``s3:``, ``hdfs:`` and others that Arrow knows) or a plain path."""

    def __init__(self, base: str):
        if ":/" in base:
            scheme, rest = base.split(":", 1)
            base = f"{scheme}://{rest}" if not rest.startswith("//") else base
            self.files, self.root = fs.FileSystem.from_uri(base)
        else:
            self.files, self.root = fs.LocalFileSystem(), base
        self._open: dict = {}

    def _path(self, name: str) -> str:
        return posixpath.join(self.root, name)

    def write(self, name: str, data: bytes) -> None:
        """All or nothing: a reader sees the old file, none, or the whole new one."""
        path = self._path(name)
        self.files.create_dir(posixpath.dirname(path), recursive=True)
        part = f"{path}.{uuid.uuid4().hex[:8]}.part"
        with self.files.open_output_stream(part) as out:
            out.write(data)
        self.files.move(part, path)

    def read(self, name: str) -> bytes:
        with self.files.open_input_stream(self._path(name)) as file:
            return file.read()

    def read_range(self, name: str, offset: int, length: int) -> bytes:
        if name not in self._open:
            if len(self._open) >= 32:
                self._open.pop(next(iter(self._open))).close()
            self._open[name] = self.files.open_input_file(self._path(name))
        return self._open[name].read_at(length, offset)
