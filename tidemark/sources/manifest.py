"""Numbered manifests: small JSON files that say which data files make up a table.

A writer puts new data files beside the old ones and then commits the next manifest. The commit moves
a complete file to a name that must be free, so of two writers that started from the same version one
is refused, and readers see the table before or after a commit, never in between. On a file system
whose rename is not atomic (plain object stores) only one writer at a time is safe.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tidemark.sources.storage import delete, file_names, move_new, read_text, write_text

_FOLDER = "_manifests"


class ConcurrentWriteError(RuntimeError):
    """Another writer has committed since this one read the table."""


class Manifests:
    """The manifests below one root; the highest number is the table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.root}/{_FOLDER}/{version:010d}.json"

    def versions(self) -> list[int]:
        names = file_names(self.spark, f"{self.root}/{_FOLDER}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self._path(version)))

    def latest(self) -> tuple[int, dict] | None:
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else None

    def commit(self, version: int, content: dict) -> None:
        """Make ``content`` version ``version``; refused when that version exists."""
        draft = f"{self.root}/{_FOLDER}/draft-{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps(content))
        if not move_new(self.spark, draft, self._path(version)):
            delete(self.spark, draft)
            raise ConcurrentWriteError(f"version {version} of {self.root} was written by another writer")

    def drop_old(self, keep: int, files_of) -> None:
        """Forget all but the ``keep`` newest versions and delete what only they refer to.

        ``files_of`` gives the paths, relative to the root, that a manifest's content refers to.
        """
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        if not old:
            return
        needed = {f for v in kept for f in files_of(self.read(v))}
        stale = {f for v in old for f in files_of(self.read(v))} - needed
        # a write's folder goes whole once nothing in it is needed
        write_of = lambda name: "/".join(name.split("/")[:2])
        used = {write_of(f) for f in needed}
        for name in sorted({f if write_of(f) in used else write_of(f) for f in stale}):
            delete(self.spark, f"{self.root}/{name}")
        for version in old:
            delete(self.spark, self._path(version))
