"""The Parquet lake: reading archive hours and the lake, writing one proven file an hour, and the permanent daily aggregates.

Layout: ``dt=YYYY-MM-DD/hr=H/events.parquet`` with the hour unpadded; columns ``dt`` and ``hr`` are in the file too.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.functions.events import AGGREGATE_FLOOR, ARCHIVE, HOURS_A_DAY, LAKE
from eventpulse.operators import marts
from eventpulse.sources import files

log = logging.getLogger(__name__)
_PARTITION = re.compile(r"/dt=(\d{4}-\d{2}-\d{2})/hr=(\d{1,2})/events\.parquet$")


class PartitionMismatch(ValueError):
    """A staged hour holds events of another hour, of several, or without a time."""


class AggregateDayMismatch(ValueError):
    """A staged aggregate holds rows of another day."""


def hour_filename(day: str, hour: int) -> str:
    """The publisher's name of an hour; the hour is unpadded."""
    if not 0 <= hour < HOURS_A_DAY:
        raise ValueError(f"no hour {hour} in a day")
    return f"{day}-{hour}.json.gz"


def partition_dir(root: str, day: str, hour: int) -> str:
    return f"{root.rstrip('/')}/dt={day}/hr={hour}"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """An hour of gzip NDJSON by a fixed schema. Other keys are ignored, malformed lines fail, lines end at \\n only; gzip can't be split."""
    return spark.read.schema(ARCHIVE).option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Only id and type of an NDJSON file; malformed lines fail."""
    return spark.read.schema("id string, type string").option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Lines as text, blank ones left out."""
    return spark.read.option("lineSep", "\n").text(path).where(F.trim("value") != "")


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """The lake with partition columns from the paths: filters on ``dt`` and ``hr`` prune folders. No files is an empty lake."""
    if not files.glob(spark, f"{root}/dt=*/hr=*/events.parquet"):
        return spark.createDataFrame([], LAKE)
    rows = spark.read.schema(LAKE).parquet(root)
    return rows.select(*[c for c in LAKE.fieldNames() if c != "hr"], F.col("hr").cast("bigint").alias("hr"))


def read_lake_in_file(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lake files with ``dt`` and ``hr`` as they are inside the files, whatever the folders say."""
    paths = [paths] if isinstance(paths, str) else paths
    return spark.read.schema(LAKE).option("recursiveFileLookup", "true").parquet(*paths) if paths else spark.createDataFrame([], LAKE)


def read_history(spark: SparkSession, root: str, kind: str, empty: str) -> DataFrame:
    """All daily aggregates of a kind, columns united by name over days. No files is an empty history of the given schema."""
    if not files.glob(spark, f"{root}/{kind}/dt=*/{kind}_daily.parquet"):
        return spark.createDataFrame([], empty)
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(f"{root}/{kind}")


def lake_files(spark: SparkSession, root: str) -> list[tuple[str, int, str, int]]:
    """(day, hour, path, bytes) of each hour's file; folders of other names are passed over with a warning."""
    found = []
    for path, size in files.glob(spark, f"{root}/*/*/events.parquet"):
        m = _PARTITION.search(path)
        if m and int(m[2]) < HOURS_A_DAY and _is_day(m[1]):
            found.append((m[1], int(m[2]), path, size))
        else:
            log.warning("not a lake partition: %s", path)
    return sorted(found)


def _is_day(text: str) -> bool:
    from datetime import date

    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


def lake_files_frame(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame([(d, h, b) for d, h, _, b in lake_files(spark, root)], "day string, hour int, bytes bigint").withColumn("day", F.col("day").cast("date"))


def present_hours(spark: SparkSession, root: str, day: str) -> list[int]:
    return [h for d, h, _, _ in lake_files(spark, root) if d == day]


def hours_by_day(spark: SparkSession, root: str) -> DataFrame:
    return lake_files_frame(spark, root).groupBy("day").agg(F.count("*").alias("hours"))


_FOOTER = "path string, rows bigint, day date, last_day date, hour bigint, last_hour bigint"


def _footers_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows and the bounds of dt and hr of each file, from the statistics of its row groups. Rows are null where the file system isn't one that can be read here."""
    for part in parts:
        told = []
        for path in part["path"]:
            try:
                system, inner = pa_fs.FileSystem.from_uri(path if "://" in path else re.sub(r"^file:/+", "/", path))
            except (pa.ArrowInvalid, OSError):
                told.append((path, None, None, None, None, None))
                continue
            with system.open_input_file(inner) as file:
                meta = pq.read_metadata(file)
            at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
            groups = [g for k in range(meta.num_row_groups) if (g := meta.row_group(k)).num_rows]
            bounds = []
            for name in ("dt", "hr"):
                stats = [g.column(at[name]).statistics if name in at else None for g in groups]
                known = stats and all(s is not None and s.has_min_max and s.null_count == 0 for s in stats)
                bounds += [min(s.min for s in stats), max(s.max for s in stats)] if known else [None, None]
            told.append((path, meta.num_rows, *bounds))
        yield pd.DataFrame(told, columns=["path", "rows", "day", "last_day", "hour", "last_hour"]).astype({"rows": "Int64", "hour": "Int64", "last_hour": "Int64"})


def footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, rows, day, last_day, hour, last_hour) of Parquet files, by executors from the footers alone: no column is read."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, min(len(paths) // 16 + 1, 1024))).mapInPandas(_footers_of, _FOOTER)


def counts_by_hour(spark: SparkSession, root: str) -> DataFrame:
    """(day, hour, n) by the files' own columns: from the footers where a file's statistics say that it holds one hour, by a scan of the others."""
    told = footers(spark, [p for _, _, p, _ in lake_files(spark, root)]).collect()  # one row a file, as the listing itself
    one = lambda r: r.rows is not None and (r.rows == 0 or (r.day is not None and (r.day, r.hour) == (r.last_day, r.last_hour)))
    plain = spark.createDataFrame([(r.day, r.hour, r.rows) for r in told if one(r) and r.rows], "day date, hour int, n bigint")
    mixed = read_lake_in_file(spark, [r.path for r in told if not one(r)]).groupBy(F.col("dt").alias("day"), F.col("hr").cast("int").alias("hour")).agg(F.count("*").alias("n"))
    return plain.union(mixed).groupBy("day", "hour").agg(F.sum("n").cast("bigint").alias("n"))


@dataclass(frozen=True)
class Written:
    path: str
    events: int
    bytes: int


def _publish(spark: SparkSession, staging: str, final: str) -> int:
    """Move the one part file of a staged write over ``final``; its size."""
    parts = files.glob(spark, f"{staging}/part-*.parquet")
    if len(parts) != 1:
        raise OSError(f"{len(parts)} files staged in {staging}")
    files.rename(spark, parts[0][0], final)
    return parts[0][1]


def write_hour(spark: SparkSession, archive: str, root: str, day: str, hour: int) -> Written:
    """Convert an hour: stage, prove that all of it belongs to that hour, and only then replace the hour's file.

    Staging folders start with an underscore, so no reader of the lake sees them; they are removed in any case.
    """
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    rows = read_archive(spark, archive).select("*", F.to_date("created_at").alias("dt"), F.hour("created_at").cast("bigint").alias("hr"))
    try:
        rows.coalesce(1).write.option("compression", "zstd").parquet(staging)  # one file an hour, from one unsplittable file
        groups = read_lake_in_file(spark, staging).groupBy("dt", "hr").count().limit(3).collect()
        if len(groups) > 1 or (groups and (str(groups[0]["dt"]), groups[0]["hr"]) != (day, hour)):
            raise PartitionMismatch(f"{archive} is not hour {hour} of {day}: it holds {[(str(g['dt']), g['hr']) for g in groups]}")
        if not groups:
            log.warning("%s holds no events", archive)
        final = f"{partition_dir(root, day, hour)}/events.parquet"
        return Written(final, groups[0]["count"] if groups else 0, _publish(spark, staging, final))
    finally:
        files.delete(spark, staging)


@dataclass(frozen=True)
class AggregateReport:
    day: str
    hours_present: int
    repos: int
    dropped: int

    @property
    def complete(self) -> bool:
        return self.hours_present == HOURS_A_DAY


def _write_day(spark: SparkSession, rows: DataFrame, root: str, kind: str, day: str) -> int:
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        rows.coalesce(1).write.option("compression", "zstd").parquet(staging)  # a day's busy repositories: some 20,000 rows
        proof = spark.read.parquet(staging).agg(F.count("*"), F.countDistinct("day"), F.min("day")).first()
        if proof[0] and (proof[1] != 1 or str(proof[2]) != day):
            raise AggregateDayMismatch(f"the {kind} aggregate of {day} holds {proof[1]} days from {proof[2]}")
        _publish(spark, staging, f"{root.rstrip('/')}/{kind}/dt={day}/{kind}_daily.parquet")
        return proof[0]
    finally:
        files.delete(spark, staging)


def aggregate_day(spark: SparkSession, lake: str, aggregates: str, day: str, floor: int = AGGREGATE_FLOOR, release: bool = False, fetch: Callable[[str, int], str | None] | None = None) -> AggregateReport:
    """Write both permanent aggregates of a day from its hours; an incomplete day is written too, and says so.

    ``fetch`` may give archive files of hours that the lake lacks. With ``release`` the day's lake files go once both aggregates stand.
    A day without any hour is refused.
    """
    here = set(present_hours(spark, lake, day))
    for hour in range(HOURS_A_DAY) if fetch else ():
        if hour not in here and (path := fetch(day, hour)):
            write_hour(spark, path, lake, day, hour)
    hours = present_hours(spark, lake, day)
    if not hours:
        raise FileNotFoundError(f"no hour of {day} in {lake}")
    rows = read_lake_in_file(spark, [f"{partition_dir(lake, day, h)}/events.parquet" for h in hours])
    if strays := rows.where(F.col("dt") != F.lit(day).cast("date")).select("dt").limit(1).collect():
        raise AggregateDayMismatch(f"the lake holds events of {strays[0][0]} under {day}")
    naive = rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    _write_day(spark, marts.ecosystem_aggregate(naive), aggregates, "ecosystem", day)
    repos = _write_day(spark, marts.repo_aggregate(naive, floor), aggregates, "repo", day)
    dropped = drop_day(spark, lake, day) if release else 0
    return AggregateReport(day, len(hours), repos, dropped)


def drop_day(spark: SparkSession, root: str, day: str) -> int:
    """Delete a day's event files, and its folders where that leaves them empty."""
    gone = 0
    for d, hour, path, _ in lake_files(spark, root):
        if d == day:
            gone += files.delete(spark, path, False)
            files.remove_if_empty(spark, partition_dir(root, day, hour))
    files.remove_if_empty(spark, f"{root.rstrip('/')}/dt={day}")
    return gone
