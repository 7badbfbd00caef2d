"""An append-only log of batches that is folded in tiers of size, under notes that say which folders hold it.

Each batch is a folder of its own. Folding reduces neighbouring batches or earlier runs of about one size to one run, so a row is rewritten once for each tier it climbs and a
read meets a few runs and the newest batches. A *generation note* lists the runs and the batches each stands for. Readers and the writer only go by the newest complete
note: a batch below a run's end is read from the run, whatever its own folder holds, so a batch that is delivered again after a lost driver changes nothing. Folders that no
note needs any more are removed after a grace period, so that a reader of an earlier generation finishes.

``fold`` reduces rows to one a key and may be applied to its own results: folding all, or folding parts first, gives the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NOTE = "first bigint, last bigint, folder string, rows bigint"


class FoldedLog:
    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], fan: int = 4):
        self.spark, self.path, self.fold, self.fan = spark, path.rstrip("/"), fold, fan

    def _status(self, path: str) -> list:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return list(system.listStatus(folder)) if system.exists(folder) else []

    def _complete(self, path: str) -> bool:
        return any(s.getPath().getName() == "_SUCCESS" for s in self._status(path))

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the complete folders ``name=<number>``, in order."""
        found = [s.getPath().getName() for s in self._status(f"{self.path}/{name}s")]
        return sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{name}=") and self._complete(f"{self.path}/{name}s/{n}"))

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batchs/batch={batch_id}"

    def generation(self) -> int:
        return max(self._numbers("generation"), default=0)

    def parts(self) -> list[tuple[int, int, str, int | None]]:
        """First and last batch, folder and rows of what makes up the log now, in order; a batch of its own has no count yet."""
        now = self.generation()
        runs = [tuple(r) for r in self.spark.read.schema(_NOTE).parquet(f"{self.path}/generations/generation={now}").collect()] if now else []
        end = max((r[1] for r in runs), default=-1)
        return sorted(runs) + [(b, b, self.batch_path(b), None) for b in self._numbers("batch") if b > end]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch; one that is there already, or that a run stands for, stays as it is."""
        if any(first <= batch_id <= last for first, last, _, _ in self.parts()):
            return
        self.fold(rows).write.mode("overwrite").parquet(self.batch_path(batch_id))

    def read(self, after: int = -1) -> DataFrame | None:
        """The rows of all parts that end beyond batch ``after``, unfolded; None for an empty log."""
        folders = [f for _, last, f, _ in self.parts() if last > after]
        return self.spark.read.parquet(*folders) if folders else None

    def current(self) -> DataFrame:
        rows = self.read()
        if rows is None:
            raise ValueError(f"{self.path}: no batch yet")
        return self.fold(rows)

    def _tier(self, rows: int) -> int:
        return int(log(max(rows, 1), self.fan) + 1e-9)

    def compact(self) -> int:
        """Fold neighbours of one tier until fewer than ``fan`` are left of each; the number of runs that were written."""
        written = 0
        while True:
            parts = [(a, b, f, n if n is not None else self.spark.read.parquet(f).count()) for a, b, f, n in self.parts()]
            stretch = self._stretch(parts)
            if not stretch:
                return written
            mine = parts[stretch[0]:stretch[1]]
            folder = f"{self.path}/runs/run={mine[0][0]}-{mine[-1][1]}-{uuid.uuid4().hex}"
            self.fold(self.spark.read.parquet(*[p[2] for p in mine])).write.parquet(folder)
            run = (mine[0][0], mine[-1][1], folder, self.spark.read.parquet(folder).count())
            # batches that are no runs yet are left to the next folding, unless older than a run
            runs = [p for p in parts[:stretch[0]]] + [run] + [p for p in parts[stretch[1]:] if "/runs/" in p[2]]
            note = self.spark.createDataFrame(runs, _NOTE).coalesce(1)
            note.write.mode("overwrite").parquet(f"{self.path}/generations/generation={self.generation() + 1}")
            written += 1

    def _stretch(self, parts: list) -> tuple[int, int] | None:
        """The first stretch of at least ``fan`` neighbours of a tier or below, lowest tier first."""
        tiers = [self._tier(p[3]) for p in parts]
        for tier in sorted(set(tiers)):
            start = 0
            for i in range(len(tiers) + 1):
                if i == len(tiers) or tiers[i] > tier:
                    if i - start >= self.fan:
                        return start, i
                    start = i + 1
        return None

    def clean(self, grace_seconds: float) -> int:
        """Remove folders the newest note does not need and that are older than the grace period; their number is returned."""
        now = self.generation()
        needed = {p[2] for p in self.parts()} | {f"{self.path}/generations/generation={now}"}
        end = max((p[1] for p in self.parts() if "/runs/" in p[2]), default=-1)
        limit = self.spark.range(1).select(F.unix_millis(F.current_timestamp())).head()[0] - 1000 * grace_seconds
        removed = 0
        for kind in ("batch", "run", "generation"):
            for status in self._status(f"{self.path}/{kind}s"):
                name = status.getPath().getName()
                path = f"{self.path}/{kind}s/{name}"
                replaced = kind == "run" or int(name.split("=")[1]) <= (end if kind == "batch" else now)
                if path not in needed and replaced and status.getModificationTime() <= limit:
                    folder = status.getPath()
                    folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
                    removed += 1
        return removed
