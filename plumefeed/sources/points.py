"""The vector table: upserts by point id on plain parquet.

Every batch of a source is one commit, a folder ``log/commit=<n>,source=<s>,batch=<b>``
whose number grows over all sources, so batch numbers of one source say nothing about those
of another. A batch that is already there is left as it is, which makes repeats harmless.
Of one point the row of the last commit counts, within a commit the one of the highest
version.

Rows are laid out in buckets by id. ``compact`` folds the log into a new base and rewrites
only the buckets that the log touches. A base lists the commits it holds and where its
buckets are; it counts once that list is finished, so a lost job leaves the old one in
force. What the base before last still needed is removed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import newest
from ..schemas import POINT, VERSION

METRIC = "cosine"
BUCKETS = 16
_COMMIT = re.compile(r"commit=(\d+),source=(\w+),batch=(\d+)$")


@dataclass(frozen=True, order=True)
class Commit:
    number: int
    source: str
    batch: int

    @property
    def folder(self) -> str:
        return f"commit={self.number:012d},source={self.source},batch={self.batch}"


class PointTable:
    """Points keyed by ``point_id`` with vectors of one dimension."""

    def __init__(self, spark: SparkSession, path: str, dim: int):
        self.spark, self.path, self.dim = spark, path.rstrip("/"), dim

    def ensure(self) -> None:
        """Create the table if it is absent; fail if it holds another dimension."""
        spec = f"{self.path}/spec"
        if not self._exists(spec):
            row = self.spark.createDataFrame([(self.dim, METRIC)], "dimension int, metric string")
            # A rival may create it first: "ignore" leaves theirs, the check below decides.
            row.coalesce(1).write.mode("ignore").parquet(spec)
        found = self.spark.read.schema("dimension int, metric string").parquet(spec).first()
        if (found.dimension, found.metric) != (self.dim, METRIC):
            raise ValueError(f"the table holds {found.dimension} dimensions by {found.metric}")

    def upsert(
        self, points: DataFrame, batch_id: int, version: str | None = None, source: str = "direct"
    ) -> None:
        """Commit one batch of ``source``; of equal ids the highest ``version`` wins.

        A batch this source has committed before changes nothing. A vector of another length
        fails the batch.
        """
        if not re.fullmatch(r"\w+", source):
            raise ValueError(f"a source is named by letters, digits and _, not {source!r}")
        self.ensure()
        folded, log = self._folded(), self._log()
        if any((c.source, c.batch) == (source, batch_id) for c in [*folded, *log]):
            return
        number = max((c.number for c in [*folded, *log]), default=-1) + 1
        order = F.col(version) if version else F.lit(0)
        length = F.size("embedding")
        checked = F.when(length == self.dim, F.col("embedding")).otherwise(
            F.raise_error(F.concat(F.lit("vector length "), length.cast("string")))
        )
        rows = points.select(
            *[F.col(f.name) for f in POINT.fields if f.name != "embedding"],
            checked.alias("embedding"),
            order.cast(VERSION).alias("version"),
        )
        batch = newest(rows, "point_id", "version").drop("version")
        target = f"{self.path}/log/{Commit(number, source, int(batch_id)).folder}"
        self._bucketed(batch).write.mode("overwrite").partitionBy("bucket").parquet(target)

    def current(self) -> DataFrame:
        """The newest version of every point.

        Buckets the log does not touch are passed through; in the others the base loses the
        points that the log replaces.
        """
        base, log = self._base(), self._open()
        touched = self._touched(log)
        out = self._rows([f for b, f in base.items() if b not in touched])
        if log:
            fresh = self._over(base, touched, log)
            out = fresh if out is None else out.unionByName(fresh)
        return self.spark.createDataFrame([], POINT) if out is None else out

    def compact(self) -> None:
        """Fold the log into a new base; nothing happens when there is no open commit."""
        log = self._open()
        if not log:
            return
        base, touched = self._base(), self._touched(log)
        last = max(self._bases(), default=-1)
        here = f"{self.path}/base/{last + 1}"
        fresh = self._over(base, touched, log)
        self._bucketed(fresh).write.mode("overwrite").partitionBy("bucket").parquet(f"{here}/points")
        places = {**base, **{b: f"{here}/points/bucket={b}" for b in touched}}
        lists = [("bucket", f"{b}", f) for b, f in places.items()]
        lists += [("commit", c.folder, "") for c in sorted({*self._folded(), *log})]
        held = self.spark.createDataFrame(lists, "kind string, name string, place string")
        held.coalesce(1).write.mode("overwrite").parquet(f"{here}/holds")
        self._expire(last, here)

    def profile(self) -> DataFrame:
        """Number of points, smallest and largest dimension, metric."""
        size = F.size("embedding")
        return self.current().agg(
            F.count("*").alias("points"),
            F.min(size).alias("min_dim"),
            F.max(size).alias("max_dim"),
            F.lit(METRIC).alias("metric"),
        )

    # --- what there is ----------------------------------------------------------------

    def _log(self) -> list[Commit]:
        """Finished commits whose folders are still there."""
        found = [_COMMIT.search(f) for f in self._finished("log/*")]
        return sorted(Commit(int(m[1]), m[2], int(m[3])) for m in found if m)

    def _bases(self) -> list[int]:
        return [int(f.split("/")[-2]) for f in self._finished("base/*/holds")]

    def _holds(self, kind: str, base: int | None = None) -> dict[str, str]:
        """Names and places that the newest base, or the given one, lists."""
        base = max(self._bases(), default=-1) if base is None else base
        if base < 0:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/base/{base}/holds").where(F.col("kind") == kind)
        return {r.name: r.place for r in rows.collect()}

    def _folded(self) -> list[Commit]:
        found = [_COMMIT.search(f) for f in self._holds("commit")]
        return [Commit(int(m[1]), m[2], int(m[3])) for m in found]

    def _base(self) -> dict[int, str]:
        return {int(b): f for b, f in self._holds("bucket").items()}

    def _open(self) -> list[Commit]:
        folded = set(self._folded())
        return [c for c in self._log() if c not in folded]

    def _touched(self, log: list[Commit]) -> set[int]:
        folders = [f for c in log for f in self._glob(f"log/{c.folder}/bucket=*")]
        return {int(f.rsplit("=", 1)[1]) for f in folders}

    # --- rows -------------------------------------------------------------------------

    def _bucketed(self, points: DataFrame) -> DataFrame:
        return points.withColumn("bucket", F.pmod(F.xxhash64("point_id"), F.lit(BUCKETS)))

    def _rows(self, folders: list[str]) -> DataFrame | None:
        there = [f for f in folders if self._glob(f.removeprefix(f"{self.path}/"))]
        if not there:
            return None
        return self.spark.read.schema(POINT).parquet(*there).select(*POINT.fieldNames())

    def _newest(self, log: list[Commit]) -> DataFrame:
        """The row of the last commit of every point in the log."""
        rows = None
        for i, c in enumerate(log):
            read = self.spark.read.schema(POINT).parquet(f"{self.path}/log/{c.folder}")
            part = read.select(*POINT.fieldNames(), F.lit(i).alias("at"))
            rows = part if rows is None else rows.unionByName(part)
        return newest(rows, "point_id", "at").select(*POINT.fieldNames())

    def _over(self, base: dict[int, str], touched: set[int], log: list[Commit]) -> DataFrame:
        """The touched buckets: rows of the log, and those of the base it does not replace."""
        fresh = self._newest(log)
        old = self._rows([f for b, f in base.items() if b in touched])
        if old is None:
            return fresh
        kept = old.join(fresh.select("point_id"), "point_id", "left_anti")
        return fresh.unionByName(kept.select(*fresh.columns))

    # --- files ------------------------------------------------------------------------

    def _expire(self, before: int, here: str) -> None:
        """Remove what neither the new base nor the one before it needs."""
        if before < 0:
            return
        for name in self._holds("commit", before):
            self._delete(f"{self.path}/log/{name}")
        needed = {*self._holds("bucket", before).values(), *self._holds("bucket").values()}
        for folder in self._glob("base/*/points/bucket=*"):
            if not any(folder.endswith(n.removeprefix(self.path)) for n in needed):
                self._delete(folder)

    @cached_property
    def _fs(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _glob(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.path}/{pattern}")) or []
        return [s.getPath().toString() for s in found]

    def _finished(self, pattern: str) -> list[str]:
        """Folders whose write has ended."""
        return [f.removesuffix("/_SUCCESS") for f in self._glob(f"{pattern}/_SUCCESS")]

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(f"{path}/_SUCCESS"))

    def _delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
