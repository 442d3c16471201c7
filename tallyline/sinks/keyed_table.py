"""Insert-or-replace by key on plain Parquet: a base split by season, and a log of batches before it.

    log/version=7/...                      one batch, each of its keys once
    base/season_id=2024/fold=6/...         the rows of a season as of version 6
    folds/version=6/...                    which folder holds each season since that fold
    writers/<stream>/batch=3/...           the version a stream's batch was given

A batch only writes its own folder, so it costs what the batch costs, and a replay replaces exactly
that folder. ``compact`` folds the log into new folders of the seasons it touches and leaves all others
as they are; the record of the fold is written last, so a reader sees the base before it or after it.
Readers group only the batches after the newest fold; the base merely loses the rows they replace.

Versions are the order of batches. A caller names its own with ``batch_id``; a stream's batches are given
the next free version at their first attempt, so a stream on a new checkpoint, whose ids begin at 0
again, comes after all that is there. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.latest import last_by_key, latest_by_key, merged
from tallyline.operators.ranking import join_on
from tallyline.schemas import TableSpec
from tallyline.workspace import stored

BATCH, SEQ = "version", "batch_seq"
FOLDS = "part string, folder string, version long"
WHOLE, NO_SEASON = "", "__HIVE_DEFAULT_PARTITION__"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec

    # -- files -------------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        """Names of what lies directly below a folder of the table."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self._names("log") if n.startswith(f"{BATCH}="))

    def _folds(self) -> tuple[dict[str, str], int]:
        """The newest folder of every season, and the version folded last (-1: none)."""
        if not self._names("folds"):
            return {}, -1
        rows = self.spark.read.schema(FOLDS).parquet(*[f"{self.path}/folds/{n}" for n in self._names("folds")])
        # One row per season and fold.
        newest = rows.groupBy("part").agg(F.max_by("folder", BATCH).alias("folder"), F.max(BATCH).alias(BATCH)).collect()
        return {r["part"]: r["folder"] for r in newest}, max(r[BATCH] for r in newest)

    def _schema(self) -> T.StructType:
        return T.StructType([*self.spec.schema.fields, T.StructField(BATCH, T.LongType())])

    # -- writing -----------------------------------------------------------------------

    def stream_version(self, stream: str, batch_id: int) -> int:
        """The version of a stream's batch: the next free one at the first attempt, the same at a replay."""
        record = f"writers/{stream}/batch={int(batch_id)}"
        if "_SUCCESS" in self._names(record):
            return self.spark.read.schema("version long").parquet(f"{self.path}/{record}").first()[0]
        version = max([-1, self._folds()[1], *self._versions()]) + 1
        line = self.spark.createDataFrame([(version,)], "version long")
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{record}")
        return version

    def upsert(self, batch: DataFrame, batch_id: int, order: Sequence[str]) -> tuple[int, int]:
        """Write one batch; returns how many rows it had, and how many different keys."""
        if batch_id < 0:
            raise ValueError(f"batch ids count from 0, got {batch_id}")
        replaced = list(self.spec.replaced)
        kept = [c for c in self.spec.schema.names if c not in replaced and c not in self.spec.keys]
        columns = [*self.spec.keys, *replaced, *kept]
        seen, written = Observation(), Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        if kept:
            sequenced = rows.select(*columns, F.struct(*order).alias(SEQ))
            one = latest_by_key(sequenced, self.spec.keys, [F.col(SEQ)], (*replaced, SEQ))
        else:
            carried = list(dict.fromkeys([*columns, *order]))
            one = last_by_key(rows.select(*carried), self.spec.keys, order)
        typed = one.select(*[F.col(f.name).cast(f.dataType) for f in self.spec.schema])
        # The version is part of the path, not data: a replay replaces exactly this folder.
        counted = typed.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.path}/log/{BATCH}={int(batch_id)}")
        return seen.get["rows"], written.get["rows"]

    def compact(self) -> None:
        """Fold the log into the base: only seasons that gain, change or lose a row are written."""
        folders, folded = self._folds()
        newest = self._newest(folded)
        if newest is None:
            return
        version = self._versions()[-1]
        if len(self._later(folded)) > 1:
            newest = stored(newest, "keyed-newest")
        names, season = self.spec.schema.names, self.spec.partition
        base = self._base(folders.values())
        if season is None:
            touched = [WHOLE]
            rows = newest if base is None else merged(base, newest, self.spec.keys, self.spec.replaced)
            self._store(rows, version, [])
        else:
            moved = newest.select(season)
            if base is not None:
                moved = moved.unionByName(join_on(base, newest.select(*self.spec.keys), self.spec.keys, "left_semi").select(season))
            # Values of the split column: as many as there are seasons.
            touched = [NO_SEASON if r[0] is None else str(r[0]) for r in moved.distinct().collect()]
            old = self._base([folders[t] for t in touched if t in folders])
            rows = newest if old is None else merged(old, newest, self.spec.keys, self.spec.replaced)
            self._store(rows.select(*names), version, [season])
        present = {n for n in self._names("base")}
        lines = []
        for part in touched:
            folder = f"fold={version}" if season is None else f"{season}={part}/fold={version}"
            there = season is None or (f"{season}={part}" in present and f"fold={version}" in self._names(f"base/{season}={part}"))
            lines.append((part, folder if there else "", version))
        self.spark.createDataFrame(lines, FOLDS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/{BATCH}={version}")

    def _store(self, rows: DataFrame, version: int, by: list[str]) -> None:
        rows = rows.hint("rebalance", *by) if by else rows
        writer = rows.withColumn("fold", F.lit(version)).write.mode("overwrite")
        # A fold that failed half-way is replaced when it is tried again; other folders stay.
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by, "fold").parquet(f"{self.path}/base")

    # -- reading -----------------------------------------------------------------------

    def _base(self, folders) -> DataFrame | None:
        paths = [f"{self.path}/base/{f}" for f in folders if f]
        if not paths:
            return None
        reader = self.spark.read.schema(self.spec.schema).option("basePath", f"{self.path}/base")
        return reader.parquet(*paths).select(*self.spec.schema.names)

    def _later(self, after: int) -> list[int]:
        return [v for v in self._versions() if v > after]

    def _log(self, after: int) -> DataFrame | None:
        """Batches behind a version. Reading just these folders tells Spark their size before it plans a join."""
        paths = [f"{self.path}/log/{BATCH}={v}" for v in self._later(after)]
        if not paths:
            return None
        return self.spark.read.schema(self._schema()).option("basePath", f"{self.path}/log").parquet(*paths)

    def _newest(self, after: int) -> DataFrame | None:
        """The last row of each key behind a version. One batch alone has each of its keys once."""
        later = self._log(after)
        if later is None:
            return None
        names = self.spec.schema.names
        if len(self._later(after)) > 1:
            if set(names) == {*self.spec.keys, *self.spec.replaced}:
                later = last_by_key(later, self.spec.keys, [BATCH])
            else:
                later = latest_by_key(later, self.spec.keys, [F.col(BATCH)], (*self.spec.replaced, BATCH))
        return later.select(*names)

    def batch(self, version: int) -> DataFrame:
        """The rows of one batch as they were written, each key once."""
        return self.spark.read.schema(self.spec.schema).parquet(f"{self.path}/log/{BATCH}={int(version)}")

    def history(self) -> DataFrame:
        """All written versions of the log, with the version of the batch that wrote them."""
        versions = self._log(-1)
        return self.spark.createDataFrame([], self._schema()) if versions is None else versions

    def current(self, only=None) -> DataFrame:
        """The last version of every key; ``only`` reads one value of the split column, and lists its folder alone."""
        season = self.spec.partition
        if only is not None and season is None:
            raise ValueError(f"{self.spec.name} is not split")
        folders, folded = self._folds()
        base = self._base(folders.values() if only is None else [folders.get(str(only), "")])
        newest = self._newest(folded)
        if newest is None:
            return self.spark.createDataFrame([], self.spec.schema) if base is None else base
        rows = newest if base is None else merged(base, newest, self.spec.keys, self.spec.replaced)
        return rows if only is None else rows.filter(F.col(season) == only)

    def pruned(self, parent: str, child: str) -> DataFrame:
        """Current rows without children that the parent's newest batch no longer wrote."""
        versions = self.history()
        newest = versions.groupBy(parent).agg(F.max(BATCH).alias(BATCH))
        live = versions.join(newest, [parent, BATCH], "left_semi").select(parent, child)
        return self.current().join(live, [parent, child], "left_semi")
