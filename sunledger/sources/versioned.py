"""A Parquet table whose state is a numbered manifest, so that a change is seen whole or not at all.

Rows lie below ``data/part=<id>/<partition>=<value>``; such a folder is written once and never changed.  A manifest names the
folders that make up each partition.  A change writes new folders and then puts the next manifest in place by a rename
that fails if it is there already: readers see the old or the new state, and of two writers one has to give way.  Besides,
a manifest carries properties, as the ledger of what has been merged; they change in the same step as the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.sources.scratch import children


class Conflict(Exception):
    """Another writer has changed the same partitions in the meantime."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    #: partition value -> ids of the parts that hold its rows
    parts: dict[str, list[str]] = field(default_factory=dict)
    properties: dict[str, object] = field(default_factory=dict)


class VersionedTable:
    """``path`` with rows of ``schema`` (column DDL), split by the string column ``partition``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition: str = "month"):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition

    # --- files -----------------------------------------------------------------

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("data").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        return children(self.spark, f"{self.path}/{folder}")

    # --- states ----------------------------------------------------------------

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest state, or that of ``version``; version 0 is the empty table."""
        if version is None:
            version = max((int(n.removesuffix(".json")) for n in self._names("manifest") if n.endswith(".json") and not n.startswith(".")), default=0)
        if not version:
            return Manifest()
        stream = self._files().open(self._at(f"manifest/{version:08d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _put(self, state: Manifest) -> bool:
        """Publish a state under its number; False if that number is taken."""
        jvm, fs = self.spark._jvm, self._files()
        held, final = self._at(f"manifest/.{uuid.uuid4().hex}"), self._at(f"manifest/{state.version:08d}.json")
        out = fs.create(held, False)
        out.write(bytearray(json.dumps(state.__dict__).encode()))
        out.close()
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(held, final, options)
        except Py4JJavaError as e:
            fs.delete(held, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def commit(self, base: Manifest, changed: Mapping[str, list[str]], properties: Mapping[str, object] | None = None) -> Manifest:
        """Publish ``base`` with some partitions pointing elsewhere.

        If others have published since, their changes stay, unless they concern one of these partitions or properties.
        """
        fresh = dict(properties or {})
        while True:
            now = self.manifest()
            moved = {p for p in changed if now.parts.get(p) != base.parts.get(p)}
            said = {k for k in fresh if now.properties.get(k) != base.properties.get(k)}
            if moved or said:
                raise Conflict(f"{self.path}: changed since version {base.version}: {sorted(moved | said)}")
            parts = {p: ids for p, ids in {**now.parts, **changed}.items() if ids}
            state = Manifest(now.version + 1, parts, {**now.properties, **fresh})
            if self._put(state):
                return state

    # --- rows --------------------------------------------------------------------

    def read(self, at: Manifest | None = None, partitions: Iterable[str] | None = None) -> DataFrame:
        """Rows of a state (the newest), with the partition column; of some partitions only these are opened."""
        state = self.manifest() if at is None else at
        wanted = state.parts if partitions is None else {p: state.parts[p] for p in sorted(partitions) if p in state.parts}
        schema = f"{self.schema}, {self.partition} string"
        folders = [f"{self.path}/data/part={i}/{self.partition}={p}" for p, ids in wanted.items() for i in ids]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).drop("part")

    def write_part(self, rows: DataFrame, sort: Iterable[str] = ()) -> tuple[str, list[str]]:
        """Write rows, which have the partition column, as a part that no state names yet; its id and its partitions.

        Rebalancing splits a large partition over tasks and packs small ones, and each file is sorted, so that filters
        on those columns skip pages.
        """
        name = uuid.uuid4().hex
        target = f"{self.path}/data/part={name}"
        rows.hint("rebalance", self.partition).sortWithinPartitions(self.partition, *sort).write.partitionBy(self.partition).parquet(target)
        lead = f"{self.partition}="
        return name, [n.removeprefix(lead) for n in self._names(f"data/part={name}") if n.startswith(lead)]

    def replace(self, rows: DataFrame, partitions: Iterable[str], base: Manifest, properties: Mapping[str, object] | None = None, sort: Iterable[str] = ()) -> Manifest:
        """Put ``rows`` in the place of the given partitions, as they were at ``base``."""
        part, found = self.write_part(rows, sort)
        return self.commit(base, {p: [part] if p in found else [] for p in {*partitions, *found}}, properties)

    def append(self, rows: DataFrame, base: Manifest, properties: Mapping[str, object] | None = None, sort: Iterable[str] = ()) -> Manifest:
        """Add ``rows`` to what the partitions held at ``base``."""
        part, found = self.write_part(rows, sort)
        return self.commit(base, {p: [*base.parts.get(p, []), part] for p in found}, properties)

    def retried(self, change: Callable[[Manifest], Manifest], times: int = 5) -> Manifest:
        """Make a change from the newest state, and again from the one that came in between."""
        for left in reversed(range(times)):
            try:
                return change(self.manifest())
            except Conflict:
                if not left:
                    raise
        raise ValueError("times has to be positive")

    def vacuum(self, keep: int = 2) -> int:
        """Remove parts that none of the newest ``keep`` states names; their number.

        Not while others write: what they have written but not published is such a part.
        """
        newest, fs = self.manifest().version, self._files()
        kept = {i for v in range(max(newest - keep + 1, 0), newest + 1) for ids in self.manifest(v).parts.values() for i in ids}
        gone = [n for n in self._names("data") if n.startswith("part=") and n.removeprefix("part=") not in kept]
        for n in gone:
            fs.delete(self._at(f"data/{n}"), True)
        for n in self._names("manifest"):
            if n.endswith(".json") and int(n.removesuffix(".json")) <= newest - keep:
                fs.delete(self._at(f"manifest/{n}"), False)
        return len(gone)


def values_of(rows: DataFrame, column: str, limit: int) -> list | None:
    """Distinct values of a column, None if there are more than ``limit``."""
    found = [r[0] for r in rows.select(F.col(column)).distinct().limit(limit + 1).collect()]
    return found if len(found) <= limit else None
