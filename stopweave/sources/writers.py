"""Writers that can be run again for a day without doubling its rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    days: tuple[date, date] | None = None,
    replace: str = "partitions",
) -> None:
    """Write ``df``, replacing the partitions it has rows for.

    With ``days``, the first and last day of the run, days in between without rows
    are removed as well; ``replace="table"`` removes everything that was there.

    ``df`` runs once. It is written into a folder that readers pass over, and takes the place of
    the old partitions only when it is complete: what fails before leaves the table as it was, and
    ``df`` may read the table it replaces. Partitions change places one by one, by renaming; what
    a run that was killed meanwhile had set aside is put back by the next run. One run at a time writes a table.

    Rows of a partition are brought together first, so that a day becomes a few
    files of good size instead of one per task; Spark splits a day that is
    larger than the others. Sorting stays inside the files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    mark = uuid.uuid4().hex
    staged, former = f"_staged-{mark}", f"_former-{mark}"
    folder = Folder(df.sparkSession, path)
    folder.recover()
    try:
        writer.format(fmt).save(f"{path}/{staged}")
        if replace == "table" or not partition_by:
            gone = [name for name in folder.names("") if name not in (staged, former)]
            come = folder.names(staged)
        else:
            come = folder.partitions(staged, len(partition_by))
            stale = _days_between(folder.names(""), days) if days else set()
            gone = sorted({name for name in come if folder.exists(name)} | (stale - {name.split("/")[0] for name in come}))
        folder.replace(staged, come, former, gone)
    finally:
        folder.delete(staged)
        folder.delete(former)


def _days_between(names: Sequence[str], days: tuple[date, date]) -> set[str]:
    """The folders of the days from the first to the last."""
    parts = ((name, *name.partition("=")[::2]) for name in names)
    return {name for name, key, day in parts if key == "date" and str(days[0]) <= day <= str(days[1])}


class Folder:
    """A table's folder on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._base = path
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self._base}/{name}" if name else self._base)

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def names(self, name: str) -> list[str]:
        """The names of what is in a folder."""
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(self._at(name))) if self.exists(name) else []

    def partitions(self, name: str, depth: int) -> list[str]:
        """The paths of the partitions below a folder, ``depth`` columns deep."""
        found = [""]
        for _ in range(depth):
            found = [f"{path}/{part}".lstrip("/") for path in found for part in self.names(f"{name}/{path}") if "=" in part]
        return found

    def move(self, name: str, to: str) -> None:
        self._system.mkdirs(self._at(to).getParent())
        if not self._system.rename(self._at(name), self._at(to)):
            raise OSError(f"could not move {self._base}/{name} to {to}")

    def replace(self, staged: str, come: Sequence[str], former: str, gone: Sequence[str]) -> None:
        """Put ``come`` of a staged folder in the place of ``gone``; a name whose turn fails gets its former back."""
        leaving = set(gone)
        for name in sorted(leaving | set(come)):
            if name in leaving:
                self.move(name, f"{former}/{name}")
            try:
                if name in come:
                    self.move(f"{staged}/{name}", name)
            except Exception:
                if name in leaving:
                    self.move(f"{former}/{name}", name)
                raise

    def recover(self) -> None:
        """Partitions that a killed run set aside return to their places, if these are empty."""
        for former in (name for name in self.names("") if name.startswith("_former-")):
            waiting = [part for part in self.names(former) if "=" in part]
            for part in waiting:
                if not self.exists(part):
                    self.move(f"{former}/{part}", part)
            self.delete(former)

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)


def write_report(metrics: DataFrame, path: str) -> None:
    """Metrics as lines of text, one report per row of ``metrics``."""
    # The lines of a model report.
    lines = F.array(
        F.lit("Model:"),
        F.lit("Model info"),
        F.format_string("RMSE: %f", "rmse"),
        F.format_string("MAE: %f", "mae"),
        F.format_string("r2: %f", "r2"),
    )
    metrics.select(F.explode(lines).alias("value")).write.mode("overwrite").text(path)


def save_model(model: object, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(model_class: type, path: str) -> object:
    return model_class.load(path)


def write_params(params: DataFrame, path: str) -> None:
    """Best parameters of tuned models; a few rows, one file."""
    params.coalesce(1).write.mode("overwrite").csv(path, header=True)
