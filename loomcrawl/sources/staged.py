"""Files that tasks write in Python and a driver moves into place: the common part of data sinks."""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage


def open_path(path: str):
    """Arrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    return fs.FileSystem.from_uri(path)


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: files below the stage, each with the folder that it belongs to, and counts."""

    files: list[tuple[str, str]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    def add(self, name: str, n: int = 1) -> None:
        self.counts[name] = self.counts.get(name, 0) + n


class StagedWriter(DataSourceArrowWriter):
    """Tasks write below a folder that the driver makes and removes: once it is gone, a task that still runs fails.

    Names hold the task and its attempt, so of a task that is tried again only what Spark counts is moved. A job that
    fails leaves nothing.
    """

    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    @property
    def stage(self) -> str:
        return f"{self.path}/_stage-{self.job}"

    def prepare(self) -> StagedWriter:
        """On the driver, before any task."""
        system, stage = open_path(self.stage)
        system.create_dir(stage, recursive=True)
        return self

    def task_folder(self):
        """(file system, the stage in it, this task's folder below it)."""
        task = TaskContext.get()
        own = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        system, stage = open_path(self.stage)
        system.create_dir(f"{stage}/{own}", recursive=False)
        return system, stage, own

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = open_path(self.path)
        stage = open_path(self.stage)[1]
        told = [m for m in messages if m is not None]
        for m in told:
            for name, folder in m.files:
                system.create_dir(f"{root}/{folder}".rstrip("/"), recursive=True)
                system.move(f"{stage}/{name}", f"{root}/{folder}/{name.rpartition('/')[2]}".replace("//", "/"))
        self.clear()
        self.finish(told)

    def finish(self, told: list[Staged]) -> None:
        """On the driver, when all files are in place."""

    def abort(self, messages: list[Staged | None]) -> None:
        self.clear()

    def clear(self) -> None:
        from pyarrow import fs

        system, stage = open_path(self.stage)
        for _ in range(5):  # a task that still runs may be adding a file
            with contextlib.suppress(OSError):
                if system.get_file_info(stage).type == fs.FileType.Directory:
                    system.delete_dir(stage)
                return
