"""Results of runs: the latest ones and all of them, changed in one commit.

A run's rows are written once, into a folder of their own that nobody reads yet. A pointer
then names all folders that count; it is swapped last, in one step. The latest results are
the last folder it names and the history is all of them, so the two can never disagree:
a failure at any moment leaves both as they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from martloom.session import delete_path
from martloom.streaming.key_index import folder_names


@dataclass
class RunTable:
    spark: SparkSession
    root: str

    def _system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{name}")

    def _pointer(self) -> tuple[int, list[list[str | None]]]:
        """Number of the last commit and [folder, run id] of every run that counts."""
        numbers = [int(n) for n in folder_names(self.spark, f"{self.root.rstrip('/')}/pointer") if n.isdigit()]
        if not numbers:
            return 0, []
        path = self._path(f"pointer/{max(numbers):012d}")
        stream = self._system(path).open(path)
        try:
            return max(numbers), json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, number: int, runs: list[list[str | None]]) -> bool:
        """Make commit `number` visible, unless another writer has taken the number."""
        draft, target = self._path(f"pointer/.draft-{uuid.uuid4().hex}"), self._path(f"pointer/{number:012d}")
        out = self._system(draft).create(draft, True)
        out.write(bytearray(json.dumps(runs).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        keep = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, keep)
        except (Py4JJavaError, PySparkException) as error:
            self._system(draft).delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def commit(self, rows: DataFrame | Callable[[], DataFrame], run_id: str | None = None) -> None:
        """Add the rows of a run. A run that has been committed under its id is not added again.

        Give rows that take work to find as a function: it is not called for a run that is there already.
        """
        folder = f"data/{uuid.uuid4().hex}"
        if run_id is not None and any(run == run_id for _, run in self._pointer()[1]):
            return
        rows = rows() if callable(rows) else rows
        rows.write.parquet(f"{self.root.rstrip('/')}/{folder}")
        while True:
            number, runs = self._pointer()
            if run_id is not None and any(run == run_id for _, run in runs):
                return
            if self._swap(number + 1, [*runs, [folder, run_id]]):
                break
        for name in folder_names(self.spark, f"{self.root.rstrip('/')}/pointer"):
            if name.isdigit() and int(name) < number:
                delete_path(self.spark, f"{self.root.rstrip('/')}/pointer/{name}")

    def _read(self, runs: list[list[str | None]]) -> DataFrame:
        if not runs:
            raise ValueError(f"no run has been committed to {self.root}")
        return self.spark.read.parquet(*[f"{self.root.rstrip('/')}/{folder}" for folder, _ in runs])

    def latest(self) -> DataFrame:
        return self._read(self._pointer()[1][-1:])

    def history(self) -> DataFrame:
        """The rows of all runs. Runs must have the same columns."""
        return self._read(self._pointer()[1])

    def vacuum(self) -> None:
        """Delete what failed runs have left. No run may be writing meanwhile."""
        used = {folder for folder, _ in self._pointer()[1]}
        for name in folder_names(self.spark, f"{self.root.rstrip('/')}/data"):
            if f"data/{name}" not in used:
                delete_path(self.spark, f"{self.root.rstrip('/')}/data/{name}")
