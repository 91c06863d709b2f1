"""Small files and folders of the shared file system, whichever one Spark is set up for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system, by the client that Spark itself uses."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder. Files that Spark takes for hidden are left out."""
    place, system = _at(spark, folder)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(name for name in names if name[0] != "." and (name[0] != "_" or "=" in name))


def delete(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.delete(place, True)


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    place, system = _at(spark, path)
    system.setTimes(place, millis, -1)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file, also into another folder, which is made if need be."""
    place, system = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    if not system.rename(place, target):
        raise OSError(f"cannot rename {path} to {to}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees the old text or the new one, and never a part.

    It is written under another name and renamed over the old one, which file systems do in one step.
    """
    folder, name = path.rsplit("/", 1)
    draft, system = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = spark._jvm.org.apache.hadoop.fs
    place, rename = files.Path(path), getattr(files, "Options$Rename")
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, place, how)


def get_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    place, system = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, folder: str, owner: str) -> None:
    """Let a folder belong to ``owner``, and refuse it if it belongs to another.

    Batches are numbered by their checkpoint, so those of a second one would replace the first one's.
    """
    mark = f"{folder.rstrip('/')}/_owner"
    known = get_text(spark, mark)
    if known is None:
        put_text(spark, mark, owner)
    elif known != owner:
        raise ValueError(f"{folder} holds the batches of {known}; name another folder for those of {owner}")
