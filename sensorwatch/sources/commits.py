"""A table of periods that several writers may append to at once.

Rows are written first, into a folder of their own; they are in the table only from the moment a manifest names that folder. Manifests are numbered
without gaps, and the file of a number can be created once: of two writers that have both found a period missing, one gets the next number,
and the other finds it taken, looks at the table again, and applies its guard to what is there now. A writer that dies between rows and manifest
leaves a folder that nobody reads.

The shared folder must be able to create a file only if it is not there: a POSIX file system (by hard link) or HDFS (by rename).
"""

import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.guard import new_period_rows
from ..session import staged


@dataclass(frozen=True)
class Claim:
    """Rows that are written, and the number of the manifest that would add them."""

    number: int
    folder: str


class PeriodTable:
    """`keys` name the period; `schema` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folders(self) -> list[str]:
        """The folders of rows that manifests name, in the order of the numbers."""
        place, system = self._place(f"{self.path}/manifests")
        if not system.exists(place):
            return []
        names = sorted(f.getPath().getName() for f in system.listStatus(place))
        numbered = [n for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()]
        if not numbered:
            return []
        read = self.spark.read.schema("number long, folder string").json([f"{self.path}/manifests/{n}" for n in numbered])
        return [r["folder"] for r in sorted(read.collect(), key=lambda r: r["number"])]

    def read(self) -> DataFrame:
        return self._rows(self.folders())

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{f}" for f in folders])

    def prepare(self, new: DataFrame, on_conflict: str = "skip_batch") -> Claim | None:
        """Write the rows that the guard lets through, as the table is now; None when it lets none through. The table does not change yet."""
        folders = self.folders()
        new = staged(new.select(*self.schema.fieldNames()), "offered")
        allowed = new_period_rows(new, self._rows(folders), self.keys, on_conflict)
        claim = Claim(len(folders) + 1, uuid.uuid4().hex)
        allowed.write.parquet(f"{self.path}/rows/{claim.folder}")
        return None if self._rows([claim.folder]).isEmpty() else claim

    def commit(self, claim: Claim) -> bool:
        """Add prepared rows; False when another writer has taken the number, and nothing has changed."""
        target = f"{self.path}/manifests/{claim.number:012d}.json"
        text = json.dumps({"number": claim.number, "folder": claim.folder}) + "\n"
        place, system = self._place(target)
        parent = place.getParent()
        system.mkdirs(parent)
        draft = self.spark._jvm.org.apache.hadoop.fs.Path(parent, f".{claim.folder}.draft")
        if system.getUri().getScheme() == "file":
            local, made = parent.toUri().getPath(), draft.toUri().getPath()
            with open(made, "w", encoding="utf-8") as out:
                out.write(text)
            try:
                os.link(made, f"{local}/{place.getName()}")
            except FileExistsError:
                return False
            finally:
                os.unlink(made)
            return True
        stream = system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if system.rename(draft, place):
            return True
        system.delete(draft, False)
        return False

    def append(self, new: DataFrame, on_conflict: str = "skip_batch") -> bool:
        """Add the rows of new periods; whether any were added. Tries again as long as another writer is faster."""
        while claim := self.prepare(new, on_conflict):
            if self.commit(claim):
                return True
        return False
