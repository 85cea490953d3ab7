"""What the micro-batches of a stream write, kept in a bounded number of folders.

Each batch writes one run, ``size=1/run=N``. Once ``width`` runs of a size are complete they are merged into one run of
``width`` times that size, named by its last batch, so a log of N batches is read from at most ``width - 1`` runs of each of
about log N sizes, and every row is rewritten once a size. Which runs exist follows from their success markers alone: a run
is live unless a complete larger run covers it. Runs are merged only once their batches are committed, so a repeated batch
writes and merges the same; merged runs are deleted ``width`` batches later, which leaves readers time to finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.session import remove_folder, subfolders

WIDTH = 8


class Runs:
    """The runs under one folder."""

    def __init__(self, spark: SparkSession, root: str, width: int = WIDTH):
        self.spark, self.root, self.width = spark, root, width

    def path(self, run: int, size: int = 1) -> str:
        return f"{self.root}/size={size}/run={run}"

    def _runs(self) -> list[tuple[int, int]]:
        """All complete runs as (batches, last batch), the largest first."""
        found = []
        for folder in subfolders(self.spark, self.root):
            size = int(folder.removeprefix("size="))
            for name in subfolders(self.spark, f"{self.root}/{folder}"):
                run = int(name.removeprefix("run="))
                if "_SUCCESS" in subfolders(self.spark, self.path(run, size), files=True):
                    found.append((size, run))
        return sorted(found, reverse=True)

    def live(self, until: int | None = None) -> list[str]:
        """Paths that together hold each complete batch once; a batch that may be a repeat reads ``until`` the one before."""
        taken, paths = [], []
        for size, run in self._runs():
            if (until is None or run <= until) and not any(run in span for span in taken):
                taken.append(range(run + 1 - size, run + 1))
                paths.append(self.path(run, size))
        return paths

    def read(self, paths: list[str], schema: str) -> DataFrame:
        """The Parquet rows of some runs, their own folder columns included in ``schema``."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, size int, run bigint").option("basePath", self.root).parquet(*paths).drop("size", "run")

    def merge_before(self, batch_id: int, combine: Callable[[list[str], str], None]) -> None:
        """Merge what is full among the batches before ``batch_id``, and drop what was merged ``width`` batches ago.

        ``combine`` writes the rows of some runs as one; it gets their paths and the new one.
        """
        if batch_id == 0 or batch_id % self.width:
            return
        runs, size, last = set(self._runs()), self.width, batch_id - 1
        while batch_id % size == 0:
            part = size // self.width
            parts = [(part, run) for run in range(last - size + part, last + 1, part) if (part, run) in runs]
            if parts and (size, last) not in runs:
                combine([self.path(run, part) for part, run in parts], self.path(last, size))
                runs.add((size, last))
            size *= self.width
        for size, run in runs:
            larger = size * self.width
            parent = (run // larger + 1) * larger - 1
            if (larger, parent) in runs and parent < batch_id - self.width:
                remove_folder(self.spark, self.path(run, size))
