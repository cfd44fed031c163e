"""Small files that publish what lies beside them: each is created whole, once, by one writer."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.mkdirs(target)


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with its text, unless there is one of that name; whether it was created.

    Of several writers one succeeds, and no reader sees half a file: the text is written under
    another name first. A local file gets its name by a hard link, others by a rename that
    replaces nothing; both are one step of the file system.
    """
    files, target = _hadoop(spark, path)
    files.mkdirs(target.getParent())
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.aside")
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            local = spark._jvm.java.nio.file.Paths.get
            empty = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
            spark._jvm.java.nio.file.Files.createLink(
                local(target.toUri().getPath(), empty), local(aside.toUri().getPath(), empty)
            )
        else:
            _rename_new(spark, aside, target)
        return True
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    finally:
        files.delete(aside, False)


def _rename_new(spark: SparkSession, source, target) -> None:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(source, target, options)


def read_marker(spark: SparkSession, path: str) -> str | None:
    """A marker's text, None where there is no such file."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def marker_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the markers of a folder, in order; none where there is no folder."""
    files, target = _hadoop(spark, folder)
    if not files.exists(target):
        return []
    found = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(name for name in found if not name.startswith("."))


def move_file(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file into place; False where it is gone already."""
    files, old = _hadoop(spark, source)
    if not files.exists(old):
        return False
    _, new = _hadoop(spark, target)
    files.mkdirs(new.getParent())
    if files.exists(new):  # a file of that name was delivered before
        new = spark._jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}")
    return files.rename(old, new)
