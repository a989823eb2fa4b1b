"""Tables that are rewritten as a whole: each version is a new Parquet folder, and a numbered pointer file names it.

Pointers are never changed: a version gets the next number, by a rename that fails where the number is taken, and the highest number is current. Readers
of an older version keep it; a crash leaves at most a folder that no pointer names; of two writers of one version, one is told
so (VersionConflict) and can start again from the other's.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from keyharbor.errors import InvalidPath, VersionConflict
from keyharbor.sources.scratch import deleted


class Table:
    def __init__(self, path: str, spark: SparkSession | None = None):
        if not path.strip("/"):
            raise InvalidPath("a table needs a folder of its own")
        self.path = path.rstrip("/")
        self._spark = spark

    @property
    def spark(self) -> SparkSession:
        return self._spark or SparkSession.active()

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("_versions").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        try:
            names = [f.getPath().getName() for f in self._files().listStatus(self._at("_versions"))]
        except Py4JJavaError as e:
            if "FileNotFoundException" not in e.java_exception.getClass().getName():
                raise
            return []
        return sorted(int(n) for n in names if re.fullmatch(r"[0-9]{12}", n))

    def _named(self, number: int) -> str:
        """The folder that a pointer names."""
        read = self._files().open(self._at(f"_versions/{number:012d}"))
        try:
            return str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(read, "UTF-8"))
        finally:
            read.close()

    def latest(self) -> tuple[int, str | None]:
        """Number and folder of the current version; (0, None) if there is none yet."""
        numbers = self._numbers()
        return (numbers[-1], self._named(numbers[-1])) if numbers else (0, None)

    def version(self) -> str | None:
        return self.latest()[1]

    def at(self, version: str | None) -> DataFrame | None:
        return None if version is None else self.spark.read.parquet(f"{self.path}/{version}")

    def read(self) -> DataFrame | None:
        """The current version; None if there is none yet."""
        return self.at(self.version())

    def save(self, df: DataFrame, after: int | None = None) -> DataFrame:
        """Writes df as the next version. after: the number of the version that df was made from; another one saved since is a VersionConflict. Without it, the last to save wins."""
        version = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{version}")
        number = (self.latest()[0] if after is None else after) + 1
        while not self._pointed(number, version):
            if after is not None:
                deleted(self.spark, f"{self.path}/{version}")
                raise VersionConflict(f"{self.path}: version {number} has been saved meanwhile")
            number += 1
        return self.spark.read.parquet(f"{self.path}/{version}")

    def _pointed(self, number: int, version: str) -> bool:
        """The pointer is written aside and renamed: it is there as a whole or not at all. False if the number is taken."""
        jvm, files = self.spark._jvm, self._files()
        aside, to = self._at(f"_versions/_{version}"), self._at(f"_versions/{number:012d}")
        out = files.create(aside, True)
        out.write(version.encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri() if to.toUri().getScheme() else files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(to), self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            files.delete(aside, False)
            return False
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all but the newest versions, pointers first; how many went. Readers of a deleted version fail: for when none is left."""
        old = self._numbers()[: -max(1, keep)]
        for number in old:
            version = self._named(number)
            self._files().delete(self._at(f"_versions/{number:012d}"), False)
            deleted(self.spark, f"{self.path}/{version}")
        return len(old)


def opened(target: Table | str) -> Table:
    return target if isinstance(target, Table) else Table(target)
