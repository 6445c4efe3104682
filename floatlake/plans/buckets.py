"""A keyed table in hash buckets: an upsert rewrites only the buckets it touches.

Data lies below ``data/version=<version>/bucket=<number>`` and never changes. A commit is one small
file that names the version of every bucket; commits are numbered, and the last one is the table.
What a writer that was cut short has left is in no commit. Creating a commit's file fails if another
writer has taken its number, so two writers never both succeed on one bucket: the later one gets
a Conflict and may try again, and writers of different buckets only take the next number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from floatlake.sources.tables import partition_values

BUCKETS = 256


class Conflict(RuntimeError):
    """Another writer has changed a bucket since it was read."""


class BucketTable:
    """Rows with a ``key``, dealt to buckets by its hash. The number of buckets is set with the first commit."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = BUCKETS):
        self._spark, self._path, self._schema, self._key = spark, path, schema, key
        self._buckets = self._last()[1].get("count", buckets)

    def _system(self, path: str):
        context = self._spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(context._jsc.hadoopConfiguration()), at

    def _last(self) -> tuple[int, dict]:
        """Number and content of the last commit; (0, {}) before the first."""
        system, folder = self._system(f"{self._path}/commits")
        if not system.exists(folder):
            return 0, {}
        numbers = sorted((int(x.getPath().getName()) for x in system.listStatus(folder) if x.getPath().getName().isdigit()), reverse=True)
        for number in numbers:
            stream = system.open(self._system(f"{self._path}/commits/{number:012d}")[1])
            text = bytes(stream.readAllBytes()).decode()
            stream.close()
            try:
                return numbers[0], json.loads(text)
            except ValueError:
                # Its writer ended before the file was whole, so the commit before it still holds.
                continue
        return (numbers[0] if numbers else 0), {}

    def _create(self, number: int, content: dict) -> bool:
        system, file = self._system(f"{self._path}/commits/{number:012d}")
        try:
            stream = system.create(file, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or "already exists" in str(error.java_exception):
                return False
            raise
        stream.write(json.dumps(content).encode())
        stream.close()
        return True

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self._key)), F.lit(self._buckets)).cast("int")

    def versions(self) -> dict[int, str]:
        """Version of each bucket that has rows."""
        return {int(k): v for k, v in self._last()[1].get("buckets", {}).items()}

    def read(self, only: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        return self._read(self.versions(), only)

    def _read(self, versions: dict[int, str], only: list[int] | None) -> DataFrame:
        paths = [f"{self._path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items()) if only is None or b in only]
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)

    def get(self, keys: list[str]) -> DataFrame:
        """Rows of some keys; only their buckets are opened."""
        wanted = self._spark.createDataFrame([(k,) for k in keys], f"{self._key} string")
        return self.get_touched(wanted).where(F.col(self._key).isin(keys))

    def get_touched(self, incoming: DataFrame) -> DataFrame:
        """Rows of all buckets that ``incoming`` has keys in."""
        return self.read([r["b"] for r in incoming.select(self.bucket().alias("b")).distinct().collect()])

    def upsert(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], writer: str) -> list[int]:
        """Replace the buckets that ``incoming`` touches by ``merge(rows there, incoming)``; their numbers.

        ``writer`` is put in front of the version's name, which is never used twice.
        """
        version = f"{writer}-{uuid.uuid4().hex}"
        before = self.versions()
        touched = sorted(r["b"] for r in incoming.select(self.bucket().alias("b")).distinct().collect())
        if not touched:
            return []
        merged = merge(self._read(before, touched), incoming).withColumn("bucket", self.bucket())
        data = f"{self._path}/data/version={version}"
        merged.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(data)
        left = set(partition_values(self._spark, f"{data}/bucket=*", "bucket"))
        while True:
            number, content = self._last()
            current = {int(k): v for k, v in content.get("buckets", {}).items()}
            changed = [b for b in touched if current.get(b) != before.get(b)]
            if changed:
                raise Conflict(f"buckets {changed} were written by another run")
            kept = {b: v for b, v in current.items() if b not in touched} | {b: version for b in touched if b in left}
            if self._create(number + 1, {"count": self._buckets, "buckets": kept}):
                return touched

    def vacuum(self) -> None:
        """Delete versions that the last commit doesn't name: no reader or writer may be at work."""
        named = set(self.versions().values())
        system, folder = self._system(f"{self._path}/data")
        for status in (system.listStatus(folder) if system.exists(folder) else []):
            if status.getPath().getName().removeprefix("version=") not in named:
                system.delete(status.getPath(), True)
