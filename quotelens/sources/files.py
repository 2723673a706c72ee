"""Small files of a store, through the file system that Spark sees."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path in full, its file system and the configuration."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = plain.getFileSystem(conf)
    return system.makeQualified(plain), system, conf


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    path, system, _ = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    full, system, _ = _at(spark, path)
    stream = system.open(full)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole or not at all; False if one of this name is there already.

    It is written under another name and then renamed, which file systems that Spark
    commits its own jobs to do in one step.
    """
    full, system, conf = _at(spark, path)
    jvm = spark._jvm
    hidden = jvm.org.apache.hadoop.fs.Path(full.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(hidden, full, options)
    except Py4JJavaError as error:
        system.delete(hidden, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    full, system, _ = _at(spark, path)
    system.delete(full, True)
