"""Small file operations on the table store, through Hadoop's file systems.

Only bookkeeping goes through here (a log entry, a lease, the removal of an
old version, which of a day's files still exist); data is always read and
written by Spark's readers and writers.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(jpath), fs


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def children(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what a folder holds, by name."""
    jpath, fs = _path(spark, folder)
    if not fs.exists(jpath):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(jpath))


def delete(spark: SparkSession, path: str) -> bool:
    """Removes a file or a folder with all in it; False if there is none."""
    jpath, fs = _path(spark, path)
    return fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    jpath, fs = _path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, replacing one of that name."""
    jpath, fs = _path(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file with its whole content, or returns False if there
    is one of that name already: of several writers exactly one succeeds.

    The content is written under a name of its own and then given the final
    one by an operation that fails if it is taken: a hard link on a local or
    mounted file system, elsewhere a rename that does not overwrite.
    """
    jpath, fs = _path(spark, path)
    if fs.exists(jpath):
        return False
    folder = jpath.getParent()
    fs.mkdirs(folder)
    own = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{jpath.getName()}-{uuid.uuid4().hex}.tmp")
    write_text(spark, own.toString(), text)
    final = fs.resolvePath(folder)
    try:
        if final.toUri().getScheme() == "file":
            nio = spark._jvm.java.nio.file
            at = lambda name: nio.Path.of(spark._jvm.java.net.URI(f"{final.toUri()}/{name}"))
            nio.Files.createLink(at(jpath.getName()), at(own.getName()))
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(jpath.toUri(), fs.getConf())
            options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(own, jpath, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(own, False)


def present(spark: SparkSession, uris: list[str]) -> list[str]:
    """Those of the files (as encoded URIs) that exist, as plain paths. Each
    folder is listed once."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(u)) for u in uris]
    folders: dict[str, set[str]] = {}
    out = []
    for p in paths:
        folder = p.getParent().toString()
        if folder not in folders:
            folders[folder] = {name for name, _ in children(spark, folder)}
        if p.getName() in folders[folder]:
            out.append(p.toString())
    return sorted(out)
