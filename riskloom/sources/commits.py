"""A numbered commit log: which version of each table is current.

Commit n is one small file that only one writer can create. A writer looks up
the last number, builds its tables aside and then claims the next number; if
another writer was faster, the claim fails, and the writer either refuses (when
the other commit replaced a table that this one was built on or replaces) or
takes the number after. Order is that of the numbers; no clock decides it.
"""

from __future__ import annotations

import json
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas

FOLDER = "_published"
TAKEN = "org.apache.hadoop.fs.FileAlreadyExistsException"


class CommitConflict(Exception):
    """Another writer has replaced one of the tables since this one began."""


def _path(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm  # the cluster's own file system, whatever it is
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def last_number(spark: SparkSession, root: str) -> int:
    """Number of the last commit; 0 when there is none."""
    files, path = _path(spark, f"{root}/{FOLDER}")
    if not files.exists(path):
        return 0
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return max((int(n.split("-")[1].split(".")[0]) for n in names if n.startswith("commit-")), default=0)


def claim(spark: SparkSession, root: str, number: int, text: str) -> bool:
    """Create commit ``number``; false when it exists already."""
    name = f"{root}/{FOLDER}/commit-{number:020d}.json"
    files, path = _path(spark, name)
    files.mkdirs(path.getParent())
    if files.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        try:
            with open(urlparse(path.toUri().toString()).path, "x") as out:
                out.write(text)
            return True
        except FileExistsError:
            return False
    try:
        out = files.create(path, False)
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getName() == TAKEN:
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The records of all whole commits; a commit still being written is not there yet."""
    log = spark.read.schema(schemas.PUBLICATION).json(f"{root}/{FOLDER}")
    whole = log.groupBy("number").agg(F.count("*").alias("n"), F.max("entries").alias("all")).where("n = all")
    return log.join(F.broadcast(whole.select("number")), "number", "left_semi")  # a number per commit


def commit(spark: SparkSession, root: str, records: list[dict], base: int | None = None, attempts: int = 1000) -> int:
    """Append the records (name, path and more) as the next commit; returns its number.

    With ``base``, the number that the writer saw when it began, a commit since
    then of one of the same names is a ``CommitConflict``. Without it the last
    writer wins. Commits of other names only move the number.
    """
    number = last_number(spark, root)
    seen = number if base is None else base
    names = {r["name"] for r in records}
    for _ in range(attempts):
        if number > seen and base is not None:
            newer = entries(spark, root).where((F.col("number") > seen) & F.col("name").isin(list(names)))
            found = sorted({r["name"] for r in newer.select("name").collect()})  # at most as many as records
            if found:
                raise CommitConflict(f"{', '.join(found)} replaced since commit {seen}")
            seen = number
        number += 1
        lines = [json.dumps({**r, "number": number, "entries": len(records)}) for r in records]
        if claim(spark, root, number, "\n".join(lines) + "\n"):
            return number
    raise CommitConflict(f"no free number after {attempts} attempts")


def current_paths(spark: SparkSession, root: str, at: int | None = None) -> dict[str, str]:
    """Path of the current version of every table, or of that which was current at commit ``at``."""
    log = entries(spark, root)
    if at is not None:
        log = log.where(F.col("number") <= at)
    latest = log.groupBy("name").agg(F.max_by("path", "number").alias("path"))
    return {r["name"]: r["path"] for r in latest.collect()}  # one row per table
