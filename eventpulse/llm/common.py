"""What the operators of this package share: table access, folds, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.sources import files

_own = threading.local()
#: ASCII white space; a word is a run of anything else.
SPACES = r"\x20\x09-\x0D"
#: Table for ``bytes.translate`` that lower-cases A-Z only.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session, whose executors are the driver, may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.gettempdir()}/eventpulse-{spark.sparkContext.applicationId}"
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that lost executors never recompute it."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    written().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While this lasts, at most so many rows go to a Python worker at once: of long texts, Spark's own number makes tens of MB on either side of the pipe."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written() -> list[str]:
    """The folders that this thread's tables were written to, in order."""
    if not hasattr(_own, "written"):
        _own.written = []
    return _own.written


def drop_all_but_last(spark: SparkSession, since: int) -> None:
    """Delete the tables written since there were so many, but the last: for callers whose last table is all that is still read."""
    for path in (gone := written()[since:-1]):
        files.delete(spark, path)
    if gone:
        del written()[since:-1]


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for df in tables:
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            for own in [p for p in written() if p.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]:
                files.delete(df.sparkSession, own)
                written().remove(own)


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a name inside one expression, so that it is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-made table; its rows pass through the JVM alone."""
    return spark.createDataFrame(rows, schema)


def labelled_sample(docs: DataFrame, usable: Column, sample: int, most_bytes: int, text_col: str = "text", label_col: str = "lang", salt: str = "language sample") -> list[tuple[str, str]]:
    """At most ``sample`` distinct (text, label), and ``most_bytes`` of text, of the least hashes of their texts.

    Labels that are null, texts that are null, and texts over ``most_bytes / 64`` bytes are left out. A first pass takes twice the share of hashes that would do if no text had a copy; where copies leave too few, passes of four times the share follow.
    """
    text, label = F.col(text_col).cast("string"), F.col(label_col).cast("string")
    rows = docs.where(usable & label.isNotNull() & text.isNotNull() & (F.octet_length(text) <= most_bytes // 64))
    count, span = rows.agg(F.count("*")).first()[0], 1 << 40
    share = min(span, 2 * span * sample // max(1, count))
    mark = F.pmod(F.xxhash64(text, F.lit(salt)), F.lit(span))
    while True:
        some = rows.select(mark.alias("mark"), text.alias("text"), label.alias("label")).where(F.col("mark") < share).groupBy("mark", "text", "label").agg(F.lit(1).alias("one"))
        some = materialize(some.select("mark", "text", "label", F.octet_length("text").alias("size")), "text-sample")
        sizes = some.select("mark", "size").orderBy("mark").limit(sample + 1).collect()
        if len(sizes) > sample or share >= span:
            break
        share = min(span, 4 * share)
    total, last = 0, -1
    for k, r in enumerate(sizes):
        total += r["size"]
        if k >= sample or total > most_bytes:
            break
        last = r["mark"]
    got = some.where(F.col("mark") <= last).toArrow()
    return [(t, x) for _, t, x in sorted(zip(*(got.column(c).to_pylist() for c in ("mark", "text", "label"))))][:sample]


#: For DuckDB, which has no crc32: a common table expression with the checksum's table, made by its rule.
CRC_TABLE = "crc as (select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) crc_t)"


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text that isn't empty, in a query that has ``CRC_TABLE`` and joins ``crc``, one row."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::bigint)"
    step = "lambda c, b: xor(c >> 8, crc_t[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {codes}), {step}))"
