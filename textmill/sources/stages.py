"""Stage tables in versions: data is written to a folder of its own, and a manifest that names it is created last.

A table is a folder with `data/<random name>/` for each write and `manifest/<number>.json` for each version. Readers take the highest number, or the
one they ask for; a write that dies leaves a data folder that no manifest names, and what was readable stays. A manifest takes the
next number that nobody has; of two writers at one moment one takes the number behind, where the file system's rename doesn't replace (HDFS; elsewhere
one writer at a time). Nothing is changed in place: going back to a version adds one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class StageTable:
    """The versions of one table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # files, by the file system that Spark reads

    def _at(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._at(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _manifest(self, version: int) -> dict:
        text = self.spark.read.text(f"{self.path}/manifest/{version:010d}.json", wholetext=True).first()
        return json.loads(text[0])

    # versions

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("manifest") if n.endswith(".json")]

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def _publish(self, entry: dict) -> int:
        fs, _ = self._at(self.path)
        said = json.dumps(entry)
        # written whole under a name of its own, then renamed: a manifest is never there in part
        d = self._at(f"{self.path}/drafts/{uuid.uuid4().hex}")[1]
        stream = fs.create(d, False)
        stream.write(bytearray(said.encode()))
        stream.close()
        fs.mkdirs(self._at(f"{self.path}/manifest")[1])
        while True:
            number = (self.latest() or 0) + 1
            target = self._at(f"{self.path}/manifest/{number:010d}.json")[1]
            if not fs.exists(target) and fs.rename(d, target):
                return number

    def write(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """A new version with df's rows. check: is given what was written and may raise, before anybody can read it as a version."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/{name}"
        df.write.parquet(folder)
        if check is not None:
            check(self.spark.read.schema(df.schema).parquet(folder))
        return self._publish({"data": name, "schema": df.schema.jsonValue()})

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the last."""
        number = self.latest() if version is None else version
        if number is None or number not in self.versions():
            raise FileNotFoundError(f"{self.path} has no version {'' if version is None else version}".rstrip())
        entry = self._manifest(number)
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.path}/data/{entry['data']}")

    def restore(self, version: int) -> int:
        """A new version that is an earlier one again; its data isn't copied."""
        return self._publish(self._manifest(version))

    def clean(self, keep: int = 1) -> list[str]:
        """Drops all but the last versions, and the data that none of those has; the folders dropped. Not to be called while others write or read old versions."""
        numbers = self.versions()
        old, new = numbers[: max(0, len(numbers) - keep)], numbers[max(0, len(numbers) - keep) :]
        used = {self._manifest(n)["data"] for n in new}
        gone = [n for n in self._names("data") if n not in used]
        for path in [*(f"manifest/{n:010d}.json" for n in old), *(f"data/{n}" for n in gone)]:
            fs, p = self._at(f"{self.path}/{path}")
            fs.delete(p, True)
        return gone
