"""Stage tables of a run that a later run goes on from.

A stage is a Parquet table with a mark beside it. The mark is written last, by renaming a finished
file, and names the table's folder and a fingerprint of what the stage was made from: its parameters and the
fingerprints of its inputs. A stage whose mark has the wanted fingerprint is read; any other,
also one that was left half-written, is made anew in a folder of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


FIELDS = "spark.sql.debug.maxToStringFields"
NAMES = re.compile(r"#\d+|CTERelation(?:Def|Ref) \d+|_pyspark_[0-9a-f]{32}")


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def of_input(df: DataFrame | None) -> str:
    """Fingerprint of a frame: what it computes, and name, size and time of every file it reads.

    A frame over data in memory is told by its plan alone, so such inputs should be written first.
    """
    if df is None:
        return fingerprint(None)
    spark, files = df.sparkSession, []
    for file in sorted(df.inputFiles()):
        fs, place = _file_system(spark, file)
        status = fs.getFileStatus(place)
        files.append((file, status.getLen(), status.getModificationTime()))
    limit = spark.conf.get(FIELDS)
    spark.conf.set(FIELDS, str(2**31 - 1))  # the plan with all its columns
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(FIELDS, limit)
    # names that Spark gives anew every time count by the order they come in
    names: dict[str, str] = {}
    plan = NAMES.sub(lambda m: names.setdefault(m[0].replace("Def", "Ref"), f"<{len(names)}>"), plan)
    return fingerprint(df.schema.json(), plan, files)


class Stages:
    """Stages under ``path``, a folder all executors reach; ``made`` and ``read`` list what this run did."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.made: list[str] = []
        self.read: list[str] = []
        self.prints: dict[str, str] = {}

    def _mark(self, name: str) -> str:
        return f"{self.path}/_marks/{name}.json"

    def marked(self, name: str) -> dict[str, str] | None:
        fs, place = _file_system(self.spark, self._mark(name))
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, mark: dict[str, str]) -> None:
        fs, place = _file_system(self.spark, self._mark(name))
        _, fresh = _file_system(self.spark, f"{self._mark(name)}.{uuid.uuid4().hex}")
        stream = fs.create(fresh)
        try:
            stream.write(bytearray(json.dumps(mark).encode()))
        finally:
            stream.close()
        fs.delete(place, False)
        if not fs.rename(fresh, place):
            raise OSError(f"could not commit stage {name}")

    def table(self, name: str, made_from: tuple[object, ...], make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage, read if it is there and made from the same things, else written.

        ``made_from``: parameters, fingerprints of inputs, and ``stage(name)`` for earlier stages. The
        folder that an older mark names is deleted once the new one stands.
        """
        wanted = fingerprint(name, *made_from)
        self.prints[name] = wanted
        old = self.marked(name)
        if old and old["fingerprint"] == wanted and _file_system(self.spark, f"{old['folder']}/_SUCCESS")[0].exists(_file_system(self.spark, f"{old['folder']}/_SUCCESS")[1]):
            self.read.append(name)
            return self.spark.read.parquet(old["folder"])
        folder = f"{self.path}/{name}-{uuid.uuid4().hex}"
        make().write.parquet(folder)
        self._commit(name, {"fingerprint": wanted, "folder": folder})
        if old:
            fs, place = _file_system(self.spark, old["folder"])
            fs.delete(place, True)
        self.made.append(name)
        return self.spark.read.parquet(folder)

    def stage(self, name: str) -> str:
        return self.prints[name]
