"""Files and folders of any file system that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(_path(spark, folder)))


def file_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of the files in a folder, by name."""
    listed = _system(spark, folder).listStatus(_path(spark, folder))
    return {status.getPath().getName(): status.getLen() for status in listed if status.isFile()}


def file_state(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """Path, size and time of the last change of a file."""
    status = _system(spark, path).getFileStatus(_path(spark, path))
    return path, status.getLen(), status.getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole; ``FileExistsError`` if it is there already."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    system = _system(spark, draft)
    stream = system.create(_path(spark, draft), True)
    stream.write(text.encode())
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_path(spark, draft).toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        # fails where the target exists, unlike a file system's plain rename
        context.rename(_path(spark, draft), _path(spark, path), options)
    except Exception as err:
        system.delete(_path(spark, draft), False)
        if "FileAlreadyExists" in str(err):
            raise FileExistsError(path) from err
        raise


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; nothing if there is none."""
    _system(spark, path).delete(_path(spark, path), True)
