"""A delivery ledger that several runs may use at once.

The ledger is a row of numbered versions. A run takes its items by creating the next version, which only one run
can; who comes second looks again at what is left. Items are written after they were claimed, never before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from .ledger import undelivered


class ClaimLedger:
    """Folders below ``folder``: ``items`` (what each claim holds), ``versions`` (claims in order), ``done``.

    The folder's file system must refuse to create a file that exists, for one of two at the same moment: HDFS does, and
    object stores with conditional writes do.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str]):
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), list(keys)

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, name: str) -> list[str]:
        path, files = self._path(name), self._files()
        return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []

    def claims(self) -> list[str]:
        """Names of the claims that hold, first to last."""
        return [v.split("-", 1)[1] for v in self._versions()]

    def _versions(self) -> list[str]:
        out = []
        for number in self._listed("versions"):
            stream = self._files().open(self._path("versions", number))
            out.append(f"{number}-{bytes(stream.readAllBytes()).decode()}")
            stream.close()
        return out

    def open_claims(self) -> list[str]:
        """Claims whose items were not noted as written: of runs that are under way, or that broke off."""
        return sorted(set(self.claims()) - set(self._listed("done")))

    def _create(self, *parts: str, text: str) -> bool:
        """Create a file; False when it is there already."""
        try:
            out = self._files().create(self._path(*parts), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def items(self, claim: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/items/{claim}")

    def claim(self, items: DataFrame) -> str | None:
        """Take the items that no claim holds; the name of the new claim, None when nothing is left."""
        while True:
            held = self.claims()
            known = self.spark.read.parquet(*[f"{self.folder}/items/{c}" for c in held]).select(*self.keys) if held else None
            name = uuid.uuid4().hex
            rows = items if known is None else undelivered(items, known, self.keys)
            rows.write.parquet(f"{self.folder}/items/{name}")
            if self.items(name).isEmpty():
                return None
            # whoever creates the next version has seen all before it
            if self._create("versions", f"{len(held) + 1:012d}", text=name):
                return name

    def deliver(self, items: DataFrame, write: Callable[[DataFrame, str], None]) -> str | None:
        """Claim, write, note. ``write`` gets the items and the claim's name, and may be called again with both."""
        name = self.claim(items)
        if name is not None:
            self.resume(name, write)
        return name

    def resume(self, claim: str, write: Callable[[DataFrame, str], None]) -> None:
        """Write a claim's items and note it as done: for the run that made the claim, or after that run broke off."""
        write(self.items(claim), claim)
        self._create("done", claim, text="")
