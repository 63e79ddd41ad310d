"""Lane tables on Parquet or JDBC.

A stream may deliver a batch twice. Each batch therefore owns the folder
``run_id=<run>/batch_id=<batch>`` and a replay overwrites it; over JDBC a replay appends
again. Either way a reader keeps the newest row of each row key.

``fold_batches`` keeps a lane cheap to read: it puts the current rows of all batches but
the newest of each run into one table by day, of which it rewrites only the days that they
touch. Readers then scan that table and, by their paths, the later batches of each run;
the files of folded batches are neither listed nor read. Several runs may write a lane at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwatch.lanes import Lane
from accountwatch.operators.keep import keep_first

BatchWriter = Callable[[DataFrame, int], None]
Sink = Callable[[Lane], BatchWriter]


def new_run_id() -> str:
    """Sorts after every earlier one, so a restart without its checkpoint outranks old batches."""
    return datetime.now(timezone.utc).strftime("run-%Y%m%dT%H%M%S.%fZ")


def parquet_sink(root: str, run_id: str, files_per_batch: int | None = None) -> Sink:
    """One folder per lane, run and batch. ``files_per_batch`` keeps sparse batches in few files."""

    def for_lane(lane: Lane) -> BatchWriter:
        def write_lane(batch: DataFrame, batch_id: int) -> None:
            if files_per_batch is not None:
                batch = batch.repartition(files_per_batch)
            batch.write.mode("overwrite").parquet(f"{root}/{lane.name}/run_id={run_id}/batch_id={batch_id}")

        return write_lane

    return for_lane


# Table names of the lanes.
TABLES = {"tickets": "high_priority_alerts", "loops": "friction_loops", "churn": "silent_churners"}


def jdbc_sink(url: str, properties: dict[str, str], run_id: str | None = None, tables: dict[str, str] = TABLES) -> Sink:
    """Append each batch to the lane's table; with a run id, tagged with its run and batch."""

    def for_lane(lane: Lane) -> BatchWriter:
        def write_lane(batch: DataFrame, batch_id: int) -> None:
            if run_id is not None:
                batch = batch.withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id).cast("long"))
            batch.write.jdbc(url=url, table=tables[lane.name], mode="append", properties=properties)

        return write_lane

    return for_lane


def console_sink(rows: int = 20) -> Sink:
    def for_lane(lane: Lane) -> BatchWriter:
        def write_lane(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            hidden = max(0, batch.count() - rows)
            print(f"{lane.name}, batch {batch_id}" + (f", {hidden} more rows not shown" if hidden else ""))
            batch.show(rows, truncate=False)
            batch.unpersist()

        return write_lane

    return for_lane


_TAGS = ("run_id", "batch_id")


def _newest_stored(stored: DataFrame, lane: Lane) -> DataFrame:
    tags = [F.desc(F.col("run_id").cast("string")), F.desc(F.col("batch_id").cast("long"))]
    counts = [lane.count, *(["feature_count"] if "feature_count" in stored.columns else [])]
    untagged = [F.desc(lane.time)] if lane.count is None else [F.desc_nulls_last(c) for c in counts]
    order = tags if set(_TAGS) <= set(stored.columns) else untagged
    if lane.count is None:
        content = [c for c in stored.columns if c not in _TAGS]
        nameless = reduce(Column.__or__, [F.col(c).isNull() for c in lane.row_key])
        stored = stored.withColumn("__content", F.when(nameless, F.to_json(F.struct(*content))))
        return keep_first(stored, [*lane.row_key, "__content"], order).drop("__content")
    return keep_first(stored, lane.row_key, order)


def newest_rows(stored: DataFrame, lane: Lane) -> DataFrame:
    """One row per row key: the last run's, and in it the last batch's.

    Rows without tags come from plain appends; there the highest counts are the newest,
    as no count of a window ever falls. Rows whose key has a null are one by their content.
    """
    return _newest_stored(stored, lane).drop(*_TAGS)


def _day(lane: Lane) -> Column:
    return F.to_date(F.timestamp_seconds(lane.time) if lane.count is None else F.col(lane.time))


#: Spark's folder for rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_FOLDS = "fold string, run_id string, batch_id long, day string, held_by string"


@dataclass(frozen=True)
class Fold:
    """What is folded: the last batch of each run, and for each day the fold that has last written it."""

    marks: dict[str, int] = field(default_factory=dict)
    days: dict[str, str] = field(default_factory=dict)


def _last_fold(spark: SparkSession, root: str, lane: Lane) -> Fold:
    """The newest complete fold of a lane."""
    try:
        folds = spark.read.schema(_FOLDS).parquet(f"{root}/{lane.name}-folds")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Fold()
    rows = folds.where(F.col("fold") == folds.agg(F.max("fold")).first()[0]).collect()
    marks = {r.run_id: r.batch_id for r in rows if r.run_id is not None}
    return Fold(marks, {r.day: r.held_by for r in rows if r.run_id is None})


def _folders(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values of ``key`` in the names of folders directly below a path. Nothing below them is listed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = (status.getPath().getName() for status in system.listStatus(folder))
    return sorted(name.removeprefix(f"{key}=") for name in names if name.startswith(f"{key}="))


def _batches_after(spark: SparkSession, root: str, lane: Lane, marks: dict[str, int]) -> dict[str, list[int]]:
    """The batches of each run above its mark; a run without a mark has none folded."""
    path = f"{root}/{lane.name}"
    later = {
        run: sorted(batch for batch in map(int, _folders(spark, f"{path}/run_id={run}", "batch_id")) if batch > marks.get(run, -1))
        for run in _folders(spark, path, "run_id")
    }
    return {run: batches for run, batches in later.items() if batches}


def _read_batches(spark: SparkSession, root: str, lane: Lane, batches: dict[str, list[int]]) -> DataFrame:
    path = f"{root}/{lane.name}"
    paths = [f"{path}/run_id={run}/batch_id={batch}" for run, ids in batches.items() for batch in ids]
    rows = spark.read.option("basePath", path).parquet(*paths)
    return rows.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("long")})


def _read_days(spark: SparkSession, root: str, lane: Lane, days: dict[str, str]) -> DataFrame | None:
    """Folded rows of some days, each from the fold that has last written it."""
    path = f"{root}/{lane.name}-bases"
    paths = [f"{path}/fold={fold}/day={day}" for day, fold in sorted(days.items())]
    return spark.read.option("basePath", path).parquet(*paths).drop("fold", "day") if paths else None


def _together(parts: list[DataFrame | None]) -> DataFrame | None:
    parts = [part for part in parts if part is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _stored_since(spark: SparkSession, root: str, lane: Lane, since: str | None) -> DataFrame:
    """The folded rows and the batches after them, both with their tags."""
    fold = _last_fold(spark, root, lane)
    days = {day: held for day, held in fold.days.items() if since is None or (day != _NO_DAY and day >= since)}
    later = _batches_after(spark, root, lane, fold.marks)
    if not later and not fold.marks:
        return spark.read.parquet(f"{root}/{lane.name}")
    batches = _read_batches(spark, root, lane, later) if later else None
    if since is not None and batches is not None:
        batches = batches.where(_day(lane) >= F.lit(since).cast("date"))
    return _together([_read_days(spark, root, lane, days), batches])


def read_lane(spark: SparkSession, root: str, lane: Lane, schema: str | None = None, since: str | None = None) -> DataFrame:
    """The current rows of a lane, with ``since`` (a date) only those of that day and later.

    With a schema, a lane nobody has written yet reads as empty.
    """
    try:
        stored = _stored_since(spark, root, lane, since)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return newest_rows(stored, lane)


def fold_batches(spark: SparkSession, root: str, lane: Lane) -> None:
    """Put the current rows of all batches but the newest of each run into the lane's table by day, for ``read_lane``.

    Only days that these batches touch are written again; the others stay with the fold
    that has written them. The newest batch of a run stays out, since it may still be
    written or delivered again. A fold counts once its marks are stored; one that breaks
    off before leaves the lane as it was. One fold of a lane runs at a time.
    """
    fold = _last_fold(spark, root, lane)
    done = {run: ids[:-1] for run, ids in _batches_after(spark, root, lane, fold.marks).items() if ids[:-1]}
    if not done:
        return
    new = _read_batches(spark, root, lane, done)
    day = F.coalesce(_day(lane).cast("string"), F.lit(_NO_DAY))
    touched = {r[0] for r in new.select(day).distinct().collect()}
    old = _read_days(spark, root, lane, {d: held for d, held in fold.days.items() if d in touched})
    name = new_run_id()
    path = f"{root}/{lane.name}-bases/fold={name}"
    _write_by_day(_newest_stored(_together([old, new]), lane), lane, path)
    # A row that has moved to another day may leave its old one empty.
    days = {d: held for d, held in fold.days.items() if d not in touched} | dict.fromkeys(_folders(spark, path, "day"), name)
    marks = fold.marks | {run: ids[-1] for run, ids in done.items()}
    rows = [(name, run, batch, None, None) for run, batch in marks.items()] + [(name, None, None, d, held) for d, held in days.items()]
    spark.createDataFrame(rows, _FOLDS).coalesce(1).write.mode("append").parquet(f"{root}/{lane.name}-folds")


def read_lane_jdbc(
    spark: SparkSession, url: str, lane: Lane, properties: dict[str, str], table: str | None = None, **partitioning: object
) -> DataFrame:
    """The same over JDBC. Pass column, lowerBound, upperBound and numPartitions to read in parallel."""
    stored = spark.read.jdbc(url=url, table=table or TABLES[lane.name], properties=properties, **partitioning)
    return newest_rows(stored, lane)


def compact_lane(spark: SparkSession, root: str, lane: Lane, out: str) -> None:
    """Write the current rows of a lane as one table by day outside the lane, for other readers."""
    _write_by_day(read_lane(spark, root, lane), lane, out)


def _write_by_day(rows: DataFrame, lane: Lane, out: str) -> None:
    # Rebalancing splits a crowded day over several files and puts quiet days together.
    days = rows.withColumn("day", _day(lane)).hint("rebalance", "day")
    days.write.mode("overwrite").partitionBy("day").parquet(out)
