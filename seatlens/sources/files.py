"""Small files and folders, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names directly in a folder; none if there is no such folder."""
    place, system = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file; its new folder is made. It is an error if the file system refuses."""
    (source, system), target = _place(spark, old), _place(spark, new)[0]
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """The files of a folder tree, relative to the folder."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return []
    start, found, listing = len(place.toUri().getPath()) + 1, [], system.listFiles(place, True)
    while listing.hasNext():
        found.append(listing.next().getPath().toUri().getPath()[start:])
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if it is."""
    place, system = _place(spark, path)
    if system.exists(place):
        return False
    # Written whole under a name of its own and then moved: nobody reads half of it.
    part = f"{path}.{spark._jvm.java.util.UUID.randomUUID()}.part"
    own = _place(spark, part)[0]
    stream = system.create(own, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(own, place):
        system.delete(own, False)
        return False
    return True
