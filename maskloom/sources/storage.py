"""Files that Python data sources read and write, on any store that all executors reach, and a log of what was committed."""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(uri)


def write_bytes(store: fs.FileSystem, path: str, data: bytes) -> None:
    """A whole small file: it is there complete, or not at all, where the store can rename."""
    with store.open_output_stream(f"{path}.part", compression=None) as out:
        out.write(data)
    store.move(f"{path}.part", path)


def read_bytes(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def files(store: fs.FileSystem, folder: str, suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, bytes) of the files right in ``folder``, or of the file itself, in order of their names."""
    info = store.get_file_info(folder)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name.endswith(suffixes) and not f.base_name.startswith(("_", ".")))


@dataclass(frozen=True)
class CommitLog:
    """One small file per batch in ``_commits``; data files that no batch names do not exist for readers.

    Tasks write files under names of their own, so what a failed or repeated task leaves behind is never seen. The driver publishes a batch with all
    its files at once. A batch that comes again under its name replaces its own entry.
    """

    uri: str

    def _folder(self) -> tuple[fs.FileSystem, str]:
        store, path = locate(self.uri)
        return store, f"{path}/_commits"

    def publish(self, batch: str, entries: list[dict], replace: bool = False) -> None:
        store, folder = self._folder()
        store.create_dir(folder, recursive=True)
        old = [p for p, _ in files(store, folder, (".json",))] if replace else []
        target = f"{folder}/{batch}.json"
        write_bytes(store, target, json.dumps(entries).encode())
        for path in old:
            if path != target:
                store.delete_file(path)

    def batches(self) -> list[str]:
        store, folder = self._folder()
        return [p.rsplit("/", 1)[1].removesuffix(".json") for p, _ in files(store, folder, (".json",))]

    def entries(self) -> list[dict] | None:
        """Entries of all batches; None if nothing was ever committed here."""
        store, folder = self._folder()
        if not exists(store, folder):
            return None
        return [e for path, _ in files(store, folder, (".json",)) for e in json.loads(read_bytes(store, path))]
