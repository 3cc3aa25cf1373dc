"""Result tables of the streaming jobs: plain parquet folders, written once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"
# Values of a partition column that are named one by one in a filter; beyond, a range is.
MOST_VALUES = 1000


class BatchTable:
    """Table that every batch replaces: the newest finished batch is read.

    Batch N lies in ``<path>/batch_id=N``. Writing a batch again replaces its folder, so a batch
    replayed after a failure leaves no trace. Batches may be left out.
    """

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def write(self, rows: DataFrame, batch_id: int) -> None:
        # A replay of this batch reads the one before it, so only what is older goes.
        for old in self._done(rows.sparkSession, batch_id - 1)[:-1]:
            _delete(rows.sparkSession, self._folder(old))
        _rebalanced(rows.select(*_names(self.schema))).write.mode("overwrite").parquet(self._folder(batch_id))

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The table as of batch ``upto``, by default the newest finished batch."""
        done = self._done(spark, upto)
        return self.batch(spark, done[-1]) if done else spark.createDataFrame([], self.schema)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What batch ``batch_id`` wrote."""
        return spark.read.schema(self.schema).parquet(self._folder(batch_id))

    def last_batch(self, spark: SparkSession) -> int:
        return max(self._done(spark), default=-1)

    def _done(self, spark: SparkSession, upto: int | None = None) -> list[int]:
        found = [b for b in _numbers(spark, self.path, BATCH) if upto is None or b <= upto]
        return sorted(b for b in found if _exists(spark, f"{self._folder(b)}/_SUCCESS"))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{BATCH}={batch_id}"


class KeyedTable:
    """Keyed table in which the row of the newest batch wins, kept as runs on levels.

    A batch writes only its own changes, as run ``batch_id`` of level 0. ``fold_every`` runs that lie
    side by side are folded into one run of the next level, so run K of level L holds the newest
    rows of the batches from K * fold_every ** L on, and a row is rewritten once a level, whatever
    the table's age. Runs are partitioned by the column ``by``: a fold opens only the days (or what
    ``by`` holds) that its own batches touched, and a read that names days opens no other files.

    Which runs there are follows from batch ids alone. A batch replayed after a failure replaces its
    run and finds the same folds; a run counts once it is complete. Runs that were folded stay until
    the fold after that, for reads under way. Batches may be left out.

    ``keep`` (rows, batch) says which rows a fold still needs in that batch. Older runs may hold older
    versions of what it drops, so readers must know these rows as void.
    """

    def __init__(
        self,
        path: str,
        schema: str,
        keys: list[str],
        by: str,
        fold_every: int = 16,
        keep: Callable[[DataFrame, int], DataFrame] | None = None,
    ):
        self.path, self.schema, self.keys, self.by = path, schema, keys, by
        self.fold_every, self.keep = fold_every, keep

    def write(self, changes: DataFrame, batch_id: int) -> None:
        self._fold(changes.sparkSession, batch_id)
        self._save(_rebalanced(changes), 0, batch_id)

    def read(
        self,
        spark: SparkSession,
        upto: int | None = None,
        only: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> DataFrame:
        """The table as of batch ``upto``, by default the newest finished batch.

        ``only`` picks keys, before versions are compared: what it drops is not shuffled. A filter
        on ``by`` in it keeps files closed.
        """
        return self._newest(spark, self._chosen(self._runs(spark), upto), only)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Only what batch ``batch_id`` wrote."""
        return self._newest(spark, [(0, batch_id)], lambda rows: rows)

    def last_batch(self, spark: SparkSession) -> int:
        return max(self._runs(spark).get(0, ()), default=-1)

    def _fold(self, spark: SparkSession, batch_id: int) -> None:
        """Folds every full block of runs that ends before ``batch_id``."""
        runs = self._runs(spark)
        level = 1
        while level <= max(runs, default=-1) + 1:
            below, here = runs[level - 1], runs.get(level, set())
            full = {r // self.fold_every for r in below if (r // self.fold_every + 1) * self.fold_every**level <= batch_id}
            for run in [r for r in below if r // self.fold_every in here and r // self.fold_every < max(here)]:
                _delete(spark, self._folder(level - 1, run))
            for block in sorted(full - here):
                rows = self._newest(spark, [(level - 1, r) for r in below if r // self.fold_every == block])
                # Clustered by key, so that a filter on keys skips files and row groups.
                order = list(dict.fromkeys([self.by, *self.keys]))
                rows = self.keep(rows, batch_id) if self.keep else rows
                rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
                self._save(rows, level, block)
            if full or here:
                runs[level] = here | full
            level += 1

    def _chosen(self, runs: dict[int, set[int]], upto: int | None) -> list[tuple[int, int]]:
        """The runs that make up the table: complete, not beyond ``upto``, and in no chosen run of a higher level."""
        chosen: set[tuple[int, int]] = set()
        for level in sorted(runs, reverse=True):
            for run in runs[level]:
                past = upto is not None and (run + 1) * self.fold_every**level - 1 > upto
                above = ((k, run // self.fold_every ** (k - level)) for k in range(level + 1, max(runs) + 1))
                if not past and not any(a in chosen for a in above):
                    chosen.add((level, run))
        return sorted(chosen)

    def _newest(
        self,
        spark: SparkSession,
        runs: list[tuple[int, int]],
        only: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> DataFrame:
        names = _names(self.schema)
        if not runs:
            return only(spark.createDataFrame([], self.schema)).select(*names)
        rows = (
            spark.read.schema(f"{self.schema}, level int, run bigint")
            .option("basePath", self.path)
            .parquet(*[self._folder(*run) for run in runs])
        )
        values = [n for n in names if n not in self.keys]
        if len(runs) == 1:
            return only(rows).select(*names)
        if not values:
            return only(rows).select(*names).distinct()
        first_batch = F.col("run") * F.pow(F.lit(self.fold_every), "level").cast("bigint")
        newest = F.max_by(F.struct(*values), first_batch).alias("newest")
        return only(rows).groupBy(*self.keys).agg(newest).select(*self.keys, "newest.*").select(*names)

    def _save(self, rows: DataFrame, level: int, run: int) -> None:
        rows.select(*_names(self.schema)).write.mode("overwrite").partitionBy(self.by).parquet(self._folder(level, run))

    def _folder(self, level: int, run: int) -> str:
        return f"{self.path}/level={level}/run={run}"

    def _runs(self, spark: SparkSession) -> dict[int, set[int]]:
        """The complete runs of each level."""
        found = {}
        for level in sorted(_numbers(spark, self.path, "level")):
            numbers = _numbers(spark, f"{self.path}/level={level}", "run")
            found[level] = {r for r in numbers if _exists(spark, f"{self._folder(level, r)}/_SUCCESS")}
        return found


class PaneStore:
    """Rows that batches add and that expire by ``pane``, a time in milliseconds.

    Rows lie in ``<path>/slot=S/batch_id=N``, S being the pane's minute, so that a range of panes is
    read and removed without opening others. Writing a batch again replaces what it wrote.
    """

    def __init__(self, path: str, schema: str, pane: str):
        self.path, self.schema, self.pane = path, schema, pane

    def write(self, rows: DataFrame, batch_id: int) -> None:
        placed = rows.withColumn("slot", self._slot(F.col(self.pane))).withColumn(BATCH, F.lit(batch_id))
        writer = _rebalanced(placed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slot", BATCH).parquet(self.path)

    def read(self, spark: SparkSession, first: int, last: int, before: int) -> DataFrame:
        """Rows of the panes from ``first`` to ``last`` that batches before ``before`` wrote."""
        slots = [s for s in _numbers(spark, self.path, "slot") if first // 60_000 <= s <= last // 60_000]
        if not slots:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(f"{self.schema}, slot bigint, {BATCH} bigint").option("basePath", self.path)
        rows = rows.parquet(*[f"{self.path}/slot={s}" for s in sorted(slots)])
        return rows.where(F.col(self.pane).between(first, last) & (F.col(BATCH) < before)).select(*_names(self.schema))

    def drop_before(self, spark: SparkSession, first: int) -> None:
        for slot in _numbers(spark, self.path, "slot"):
            if slot < first // 60_000:
                _delete(spark, f"{self.path}/slot={slot}")

    @staticmethod
    def _slot(pane: Column) -> Column:
        return F.floor(pane / 60_000).cast("bigint")


def values_of(rows: DataFrame, column: str) -> Column:
    """A filter that holds for the values of ``column`` in ``rows``, made so that partitions can be left out.

    Names the values where there are at most MOST_VALUES of them, else their range.
    """
    found = [r[0] for r in rows.select(column).distinct().limit(MOST_VALUES + 1).collect()]
    if len(found) <= MOST_VALUES:
        return F.col(column).isin([v for v in found if v is not None]) | (F.lit(None in found) & F.col(column).isNull())
    first, last = rows.agg(F.min(column), F.max(column)).first()
    return F.col(column).between(F.lit(first), F.lit(last)) | F.col(column).isNull()


def _names(schema: str) -> list[str]:
    return StructType.fromDDL(schema).names


def _rebalanced(rows: DataFrame) -> DataFrame:
    """As many writers as the rows' size asks for, where adaptive execution can tell."""
    return rows.hint("rebalance") if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true" else rows


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def _delete(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Values of the ``<name>=<number>`` folders below ``path``."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    found = [status.getPath().getName() for status in files.listStatus(location)]
    return [int(f.split("=")[1]) for f in found if f.startswith(f"{name}=")]


def stamp_files(spark: SparkSession, path: str, millis: int) -> None:
    """Sets the modification time of the files in a folder."""
    files, location = _file_system(spark, path)
    for status in files.listStatus(location):
        files.setTimes(status.getPath(), millis, -1)
