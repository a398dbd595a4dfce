"""Tables whose content changes in one step.

A table is a folder with data folders in it, and ``_manifest``, a folder of empty files whose names say
which of them count:

* ``<number>.<key>.<data folder>``: from this change on, the key's rows are in that data folder;
* ``<number>.commit``: the change is complete. Entries of a number without it count for nothing.

Of each key the entry with the largest committed number counts. Creating the commit file is the one step at
which readers see a change, whatever number of keys it has; until then, and after a writer that was lost on
the way, they see the table as it was. Nothing that is read is ever renamed or overwritten, so this holds on
object stores as well. One writer at a time: a number is claimed by creating a file, which only
some stores refuse to do twice.

Replaced data folders stay for those who still read them, until ``clean_up`` removes them.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

_MANIFEST = "_manifest"
#: Data folders are named like partitions, so that folders of several of them can be read together.
DATA = "data"
_NAME = re.compile(r"(\d{12})\.(?:(claim|commit)|([\w-]+)\.(data=\w+))")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path in its terms."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _names(spark: SparkSession, path: str) -> list[tuple[int, str | None, str | None, str | None]]:
    """(number, claim or commit, key, data folder) of each file in the manifest."""
    files, location = file_system(spark, f"{path.rstrip('/')}/{_MANIFEST}")
    if not files.exists(location):
        return []
    found = (_NAME.fullmatch(status.getPath().getName()) for status in files.listStatus(location))
    return [(int(m[1]), m[2], m[3], m[4]) for m in found if m]


def _counting(names: list[tuple], upto: int | None = None) -> dict[str, tuple[int, str]]:
    """Key → number and data folder, after the committed changes up to a number."""
    committed = {number for number, mark, _, _ in names if mark == "commit" and (upto is None or number <= upto)}
    found: dict[str, tuple[int, str]] = {}
    for number, mark, key, folder in names:
        if mark is None and number in committed:
            found[key] = max(found.get(key, (number, folder)), (number, folder))
    return found


def begin(spark: SparkSession, path: str) -> None:
    """Make the folder a table of this kind, so that what is written to it isn't taken for its rows. One with
    files in it that isn't such a table is refused: they would be hidden."""
    files, root = file_system(spark, path.rstrip("/"))
    _, location = file_system(spark, f"{path.rstrip('/')}/{_MANIFEST}")
    if not files.exists(location) and files.exists(root) and files.listStatus(root):
        raise FileExistsError(f"{path} holds files that aren't a published table's")
    files.mkdirs(location)


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether the folder is a table of this kind, with or without a change so far."""
    files, location = file_system(spark, f"{path.rstrip('/')}/{_MANIFEST}")
    return files.exists(location)


def live_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Key → data folder, as a path, of what the table holds now."""
    root = path.rstrip("/")
    counting = _counting(_names(spark, path))
    return {key: f"{root}/{folder}" for key, (_, folder) in sorted(counting.items())}


def new_folder(path: str) -> str:
    """A data folder's path, for rows to be written to and published afterwards."""
    return f"{path.rstrip('/')}/{DATA}={uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, changes: Mapping[str, str]) -> int:
    """Let the keys' rows be those in the given data folders of the table, all at once; returns the change's
    number."""
    files, _ = file_system(spark, path)
    root = f"{path.rstrip('/')}/{_MANIFEST}"

    def create(name: str) -> bool:
        _, location = file_system(spark, f"{root}/{name}")
        return files.createNewFile(location)

    number = max((n for n, *_ in _names(spark, path)), default=0) + 1
    while not create(f"{number:012d}.claim"):
        number += 1
    for key, folder in changes.items():
        name = f"{number:012d}.{key}.{folder.rstrip('/').rpartition('/')[2]}"
        if not _NAME.fullmatch(name):
            raise ValueError(f"key {key!r} can't be part of a file name")
        create(name)
    create(f"{number:012d}.commit")
    return number


def clean_up(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86_400) -> list[str]:
    """Remove data folders that none of the last ``keep`` states of the table counts, and that are older than
    so many seconds: replaced ones, and those of rejected or lost writers. Returns their names."""
    names = _names(spark, path)
    last = sorted(number for number, mark, _, _ in names if mark == "commit")
    states = [_counting(names, number) for number in last[-keep:]]
    needed = {folder for state in states for _, folder in state.values()}
    files, location = file_system(spark, path)
    gone = []
    for status in files.listStatus(location) if files.exists(location) else []:
        name = status.getPath().getName()
        old = status.getModificationTime() / 1000 <= time.time() - older_than
        if name.startswith(f"{DATA}=") and name not in needed and old:
            files.delete(status.getPath(), True)
            gone.append(name)
    # Names of entries that no kept state counts only make listings longer.
    for number, mark, key, folder in names:
        if mark is None and folder in gone:
            _, entry = file_system(spark, f"{path.rstrip('/')}/{_MANIFEST}/{number:012d}.{key}.{folder}")
            files.delete(entry, False)
    return sorted(gone)
