"""Full CSV snapshots of reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.files import Change, Folder, Replacement, publish_all
from quayside.functions import plain_decimal, plain_double
from quayside.session import size_shuffles

# Stores without folders: renaming one there copies object by object.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cos", "swift")
POINTER = "current"
MARK = "_published"
#: Seconds after which a run that was never published counts as left behind by a lost writer.
ABANDONED = 7 * 24 * 3600


def plain_text(rows: DataFrame) -> DataFrame:
    """Numbers the way a spreadsheet expects them: no padding zeros, no exponents."""
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale > 0:
            column = plain_decimal(column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = plain_double(column)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def write_snapshot(
    rows: DataFrame,
    path: str,
    sep: str = ";",
    line_end: str = "\n",
    compact: bool = False,
    pointer: bool | None = None,
) -> None:
    """Replace the CSV folder ``path`` by the current rows.

    Each part file starts with the header, so does the only one of an empty report. Fields are
    quoted only where needed, quotes are doubled, NULL is an empty field, spaces stay, line breaks
    in a field become ``line_end``. ``compact`` evens out the part files by size with one more
    shuffle: a small report becomes one file, a large one stays in several.

    The rows are written to a folder of their own and published once that has succeeded, so a
    failing run leaves the last snapshot as it is and no reader sees a part of one. On file systems
    the new folder takes the old one's name. On object stores (or with ``pointer``) each run keeps
    its folder under ``path``, and the small file ``current``, written last, names the one to read;
    see ``snapshot_folder``. The run before stays for those who still read it, and so do
    the runs of other writers that are still at work.
    """
    publish_all([stage_snapshot(rows, path, sep, line_end, compact, pointer)])


def stage_snapshot(
    rows: DataFrame,
    path: str,
    sep: str = ";",
    line_end: str = "\n",
    compact: bool = False,
    pointer: bool | None = None,
) -> Change:
    """Write the rows aside, as ``write_snapshot`` does first; ``publish_all`` makes them the snapshot."""
    size_shuffles(rows)
    files = Folder(rows.sparkSession, path)
    if pointer is None:
        pointer = files.scheme in OBJECT_STORES
    run = f"run-{uuid.uuid4().hex}"
    new = files.child(run) if pointer else files.beside(f"new-{run}")
    try:
        _write(rows, new, sep, line_end, compact)
    except BaseException:
        files.delete(new)
        raise
    return _Run(files, run) if pointer else Replacement(files, files.path, new)


def snapshot_folder(spark: SparkSession, path: str) -> str:
    """The folder with the current rows of a snapshot: ``path``, or the run that its pointer names."""
    named = _pointed(Folder(spark, path))
    return f"{path.rstrip('/')}/{named[0]}" if named else path


def _pointed(files: Folder) -> list[str]:
    """The current run and the one before, as far as there are any."""
    return (files.read(files.child(POINTER)) or "").split()


class _Run:
    """A run folder that the pointer is to name.

    A run that was named once is marked after that. Marked ones, which the pointer names no more, are cleaned up; one without
    a mark belongs to a writer still at work, unless it is ``ABANDONED``.
    """

    def __init__(self, files: Folder, run: str):
        self.files, self._run = files, run

    def publish(self) -> None:
        self._before = _pointed(self.files)
        self.files.write(self.files.child(POINTER), "\n".join([self._run, *self._before[:1]]))

    def undo(self) -> None:
        if self._before:
            self.files.write(self.files.child(POINTER), "\n".join(self._before))
        else:
            self.files.delete(self.files.child(POINTER))

    def finish(self) -> None:
        self.files.write(self.files.child(f"{self._run}/{MARK}"), "")
        # Listed first: a run marked by now was named before, so the pointer read after it is no older.
        runs = [child for child in self.files.children() if child.name.startswith("run-")]
        named = _pointed(self.files)
        for child in runs:
            if child.name not in named and (self.files.exists(self.files.child(f"{child.name}/{MARK}")) or child.age > ABANDONED):
                self.files.delete(self.files.child(child.name))

    def discard(self) -> None:
        self.files.delete(self.files.child(self._run))


def _write(rows: DataFrame, path: str, sep: str, line_end: str, compact: bool) -> None:
    text = plain_text(rows)
    if compact:
        text = text.hint("rebalance")
    # The comment sign is one that never occurs: a row starting with it would be quoted.
    text.write.option("comment", "\x01").csv(
        path,
        header=True,
        sep=sep,
        lineSep=line_end,
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
