"""Listings and small text files through Hadoop's ``FileSystem`` of the running session.

Every path that Spark reads works here too, with its scheme and authority kept
(``hdfs://nn:8020/...``, ``s3a://...``, ``abfss://c@account/...``, ``file:`` and plain local paths).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext


def _context() -> SparkContext:
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("file access needs a running Spark session")
    return context


def _resolve(path: str):
    """(JVM, file system, Hadoop path) of a path."""
    context = _context()
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return context._jvm, found.getFileSystem(context._jsc.hadoopConfiguration()), found


def hidden(name: str) -> bool:
    """Whether Spark's readers skip a file or folder of this name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def qualified(path: str) -> str:
    """The path with the scheme and authority that its file system gives it."""
    _, filesystem, found = _resolve(path)
    return filesystem.makeQualified(found).toString()


def list_files(path: str) -> list[str]:
    """Qualified files under ``path`` (a file or a folder), without hidden ones."""
    _, filesystem, found = _resolve(path)
    root = qualified(path).rstrip("/")
    if filesystem.getFileStatus(found).isFile():
        return [root]
    files, entries = [], filesystem.listFiles(found, True)
    while entries.hasNext():
        name = entries.next().getPath().toString()
        if not any(hidden(part) for part in name[len(root):].split("/") if part):
            files.append(name)
    return sorted(files)


def child_names(path: str) -> list[str]:
    """Names directly under a folder; none where it does not exist."""
    _, filesystem, found = _resolve(path)
    if not filesystem.exists(found):
        return []
    return sorted(s.getPath().getName() for s in filesystem.listStatus(found))


def first_line(path: str) -> str:
    """First line of a text file that is not blank, read to its end ('' where there is
    none); compressed by its name, without a byte-order mark."""
    jvm, filesystem, found = _resolve(path)
    stream = filesystem.open(found)
    try:
        factory = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(_context()._jsc.hadoopConfiguration())
        codec = factory.getCodec(found)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = reader.readLine()
        while line is not None:
            line = line.removeprefix("\ufeff")
            if line.strip():
                return line
            line = reader.readLine()
        return ""
    finally:
        stream.close()


def path_exists(path: str) -> bool:
    _, filesystem, found = _resolve(path)
    return filesystem.exists(found)


def read_text(path: str) -> str:
    jvm, filesystem, found = _resolve(path)
    stream = filesystem.open(found)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    """Write a small text file whole: to a temporary name, then renamed over the
    target, so a crash never leaves a half-written file."""
    _put_text(path, text, overwrite=True)


def create_text(path: str, text: str) -> bool:
    """Write a small text file whole unless the name is taken; whether it was written."""
    if path_exists(path):
        return False
    try:
        _put_text(path, text, overwrite=False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        return False
    return True


def _put_text(path: str, text: str, overwrite: bool) -> None:
    jvm, filesystem, target = _resolve(path)
    context = _context()
    temporary = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{target.getName()}.tmp-{uuid.uuid4().hex[:8]}")
    if target.getParent() is not None:
        filesystem.mkdirs(target.getParent())
    out = filesystem.create(temporary)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(rename, int(overwrite))
    if overwrite:
        options[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            filesystem.getUri(), context._jsc.hadoopConfiguration()).rename(
            filesystem.makeQualified(temporary), filesystem.makeQualified(target), options)
    except Py4JJavaError:
        filesystem.delete(temporary, False)
        raise


def remove_dir(path: str) -> None:
    """Delete a folder this library created (no error if it is already gone)."""
    _, filesystem, found = _resolve(path)
    filesystem.delete(found, True)


def move_dir(new: str, path: str) -> None:
    """Rename a folder to a name that is free."""
    _, filesystem, target = _resolve(path)
    _, _, source = _resolve(new)
    filesystem.mkdirs(target.getParent())
    if not filesystem.rename(source, target):
        raise OSError(f"cannot move {new} to {path}")


def _retired(path: str) -> str:
    """Where the folder that ``replace_dir`` takes away stands until the new one is in place."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/.{name}.old"


def replace_dir(new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``: the old folder is renamed
    away, the new one renamed in, then the old one deleted.  A crash in between leaves the
    old folder under its other name, from where ``restore_dir`` brings it back."""
    _, filesystem, target = _resolve(path)
    jvm, _, source = _resolve(new)
    old = jvm.org.apache.hadoop.fs.Path(_retired(path))
    filesystem.mkdirs(target.getParent())
    restore_dir(path)
    filesystem.delete(old, True)
    if filesystem.exists(target) and not filesystem.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if not filesystem.rename(source, target):
        restore_dir(path)
        raise OSError(f"cannot move {new} to {path}")
    filesystem.delete(old, True)


def restore_dir(path: str) -> bool:
    """Bring back a folder whose replacement was broken off; whether there was one."""
    jvm, filesystem, target = _resolve(path)
    old = jvm.org.apache.hadoop.fs.Path(_retired(path))
    if filesystem.exists(target) or not filesystem.exists(old):
        return False
    return filesystem.rename(old, target)
