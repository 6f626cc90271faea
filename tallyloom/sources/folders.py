"""Folder operations on whatever file system a path names."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``, hidden ones left out."""
    fs, p = _resolve(spark, path)
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else ()
    return sorted(n for n in names if not n.startswith((".", "_")))


def create(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file whole, or not at all if one of that name is there; of several writers exactly one succeeds.

    The content is written under a hidden name first. A rename onto an existing file is refused by distributed file systems;
    a local one would replace it, so there the name is given by a hard link.
    """
    fs, target = _resolve(spark, path)
    folder, name = target.getParent(), target.getName()
    pending = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{name}-{uuid.uuid4().hex}")
    out = fs.create(pending, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(target) and fs.rename(pending, target)
        try:
            os.link(fs.makeQualified(pending).toUri().getPath(), fs.makeQualified(target).toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        fs.delete(pending, False)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, from the file system's own summary."""
    fs, p = _resolve(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.delete(p, True)


def switch(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of ``path``; the old one is removed only once the new one is there."""
    fs, target = _resolve(spark, path)
    _, source = _resolve(spark, staged)
    previous = None
    if fs.exists(target):
        _, previous = _resolve(spark, f"{path.rstrip('/')}.previous-{uuid.uuid4().hex}")
        if not fs.rename(target, previous):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        if previous is not None:
            fs.rename(previous, target)
        raise OSError(f"cannot move {staged} to {path}")
    if previous is not None:
        fs.delete(previous, True)
