"""Whole-path operations on any file system that Spark can reach; names and lengths only, never content."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """(file system, path) as the JVM sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _open(spark, path)
    return files.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds; one that is absent is no error."""
    files, found = _open(spark, path)
    files.delete(found, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder, sorted; none where it is absent."""
    files, found = _open(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(found)) if files.exists(found) else []


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder however deep, or the file itself; names that begin with ``_`` or ``.`` are no data."""
    files, found = _open(spark, path)
    if not files.getFileStatus(found).isDirectory():
        return [path]
    names = [s.getPath().getName() for s in files.listStatus(found)]
    return [f for name in sorted(names) if name[0] not in "_." for f in files_below(spark, f"{path.rstrip('/')}/{name}")]


def _rename(files, source, target) -> bool:
    return files.rename(source, target)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder. A target that exists is an error: some file systems would put the source inside it."""
    files, old = _open(spark, source)
    _, new = _open(spark, target)
    if files.exists(new):
        raise FileExistsError(f"{target} exists")
    files.mkdirs(new.getParent())
    if not _rename(files, old, new) or files.exists(old) or not files.exists(new):
        raise OSError(f"could not move {source} to {target}")


def mark_done(spark: SparkSession, folder: str) -> None:
    files, found = _open(spark, f"{folder}/_SUCCESS")
    files.create(found, True).close()


# A run over many days has one folder below the root, which readers do not see for its name. It holds
#   _day=<day>     a new day, until it is put in place
#   _before=<day>  the old day, from when it is set aside until the new one stands
#   _manifest      their layout and names, written when all new days are complete: from here on days change places
_STAGING = "_staging-"
_MANIFEST = "_manifest"
STALE_SECONDS = 86_400


def _target(root: str, layout: str, day: str) -> str:
    return f"{root.rstrip('/')}/{layout.format(day=day)}"


def _swap(spark: SparkSession, staging: str, target: str, day: str) -> None:
    """Set the old day aside, then put the new one in its place."""
    if exists(spark, target):
        move_folder(spark, target, f"{staging}/_before={day}")
    move_folder(spark, f"{staging}/_day={day}", target)


def _settle(spark: SparkSession, root: str, staging: str) -> None:
    """Every day that was set aside and has nothing in its place gets the new folder, or else the old one back."""
    names = names_in(spark, staging)
    layout = _read_text(spark, f"{staging}/{_MANIFEST}").split("\n")[0] if _MANIFEST in names else ""
    for name in names if layout else []:
        kind, _, day = name.partition("=")
        target = _target(root, layout, day)
        if kind != "_before" or exists(spark, target):
            continue
        try:
            move_folder(spark, f"{staging}/_day={day}", target)
        except Exception:  # whatever kept the new folder away, the old one must not stay aside
            if not exists(spark, target):
                move_folder(spark, f"{staging}/{name}", target)
    delete(spark, staging)


def recover_days(spark: SparkSession, root: str, stale_seconds: float = STALE_SECONDS) -> list[str]:
    """Finish or undo what runs that died left below ``root``; the names of the folders that were settled.

    A day that such a run had set aside gets its new folder, which was complete by then, or the old one if that fails; a day
    that stands is never touched, so nothing written since is lost. A run that has not begun to move days may still be
    writing: its folder goes only if nothing in it changed for ``stale_seconds``. The manifest names the layout of its days, so
    datasets may share a root; each has one writer at a time.
    """
    root = root.rstrip("/")
    settled = []
    for name in names_in(spark, root):
        staging = f"{root}/{name}"
        if name.startswith(_STAGING) and (exists(spark, f"{staging}/{_MANIFEST}") or _age(spark, staging) > stale_seconds):
            _settle(spark, root, staging)
            settled.append(name)
    return settled


def _age(spark: SparkSession, folder: str) -> float:
    """Seconds since the folder, or anything directly or two levels below it, changed."""
    files, found = _open(spark, folder)
    changed = files.getFileStatus(found).getModificationTime()
    for status in files.listStatus(found):
        below = [status, *(files.listStatus(status.getPath()) if status.isDirectory() else [])]
        changed = max(changed, *[s.getModificationTime() for s in below])
    return time.time() - changed / 1000


def _write_manifest(spark: SparkSession, staging: str, layout: str, days: Sequence[str]) -> None:
    """The layout and days of the run, as one file that appears whole: written under another name, then renamed."""
    files, draft = _open(spark, f"{staging}/{_MANIFEST}.draft")
    _, final = _open(spark, f"{staging}/{_MANIFEST}")
    out = files.create(draft, True)
    out.write(bytearray("\n".join([layout, *days]).encode()))
    out.close()
    if not files.rename(draft, final):
        raise OSError(f"could not write the manifest of {staging}")


def _read_text(spark: SparkSession, path: str) -> str:
    files, found = _open(spark, path)
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def staged_days(spark: SparkSession, root: str, layout: str) -> Iterator[tuple[str, list[date]]]:
    """A staging folder for one job over many days, whose days are then moved to ``<root>/<layout>`` one by one.

    The body writes ``<staging>/_day=<day>`` partitions and gets a list that holds the days moved afterwards. A body
    that fails leaves the days under ``root`` as they were. A move that fails leaves the old or the new folder of its day in
    place; so does a process that dies, once the next run or ``recover_days`` has settled what it left.
    """
    root = root.rstrip("/")
    recover_days(spark, root)
    staging, moved = f"{root}/{_STAGING}{uuid.uuid4().hex}", []
    try:
        yield staging, moved
        days = [name[5:] for name in names_in(spark, staging) if name.startswith("_day=")]
        for day in days:
            mark_done(spark, f"{staging}/_day={day}")
        if days:
            _write_manifest(spark, staging, layout, days)
        for day in days:
            _swap(spark, staging, _target(root, layout, day), day)
            moved.append(date.fromisoformat(day))
    finally:
        _settle(spark, root, staging)


def drop_folders(spark: SparkSession, root: str, layout: str, days: Sequence[date]) -> None:
    for day in days:
        delete(spark, f"{root}/{layout.format(day=day.isoformat())}")
