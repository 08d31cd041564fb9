"""Streams of items: daily counts with late rows, de-duplication, and the rolling archive as a keyed state table."""

from __future__ import annotations

import json
import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clipfold.operators import items as it
from clipfold.operators import merge
from clipfold.operators.dims import DEFAULT, Dimensions, origin
from clipfold.plans.cut import delete, file_system
from clipfold.sources.state import exists


def read_items(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """New files of a folder, a few a batch, as normalised items."""
    return it.normalise(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path))


def daily_counts(stream: DataFrame, late: str = "8 days", dims: Dimensions = DEFAULT) -> DataFrame:
    """Items by day, area and origin, kept open for rows published up to ``late`` before their run.

    In append mode a day comes out once, when the watermark has passed it, and its state goes; in update mode it comes out
    whenever it changes.
    """
    timed = stream.where("ts is not null and area <> ''").withColumn("momento", F.col("ts").cast("timestamp"))
    counts = timed.withWatermark("momento", late).groupBy(F.window("momento", "1 day").alias("w"), "area", origin("dominio", dims).alias("origem")).agg(F.count("*").alias("noticias"))
    return counts.select(F.col("w.start").cast("date").alias("data"), "area", "origem", "noticias")


def upsert_counts(changed: DataFrame, number: int, root: str) -> None:
    """For ``foreachBatch`` in update mode: each batch's changed days, kept as a table of its own; retries overwrite it."""
    changed.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{root}/b={number}")


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """The latest count of each day, area and origin."""
    key = ["data", "area", "origem"]
    return spark.read.parquet(f"{root}/b=*").groupBy(*key).agg(F.max_by("noticias", "batch").alias("noticias"))


def first_seen(stream: DataFrame, late: str = "8 days") -> DataFrame:
    """Each address once within the time its state is kept."""
    timed = stream.where("ts is not null and ligacao <> ''").withColumn("momento", F.col("ts").cast("timestamp"))
    return timed.withWatermark("momento", late).dropDuplicatesWithinWatermark(["ligacao"])


KEY = ["area", "titulo", "fonte"]
FILL = ["resumo", "imagem", "ligacao", "dominio", "grupo"]


#: A version: its number, and the run of the stream and the batch that made it.
_VERSION = re.compile(r"v=(\d{12})-([0-9a-f-]+)-(\d+)$")
_DONE = "_SUCCESS"


def versions(spark: SparkSession, root: str) -> list[tuple[int, str, int, str]]:
    """``number, run, batch, path`` of the complete versions at ``root``, oldest first."""
    p, fs = file_system(spark, root)
    if not fs.exists(p):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(p)]
    found = [(int(m.group(1)), m.group(2), int(m.group(3)), f"{root}/{n}") for n in names if (m := _VERSION.match(n)) and exists(spark, f"{root}/{n}/{_DONE}")]
    return sorted(found)


def merge_batch(batch: DataFrame, run: str, number: int, root: str, as_of: datetime, days: int = 7, keep: int = 3) -> None:
    """Merge a batch into the archive at ``root``: the next version is retained old and new rows, older runs first.

    A version bears the run of its stream and the batch, so a batch retried after a failure finds its version complete, and
    batch 0 of a new run goes on from the newest one. A batch whose predecessor has no version raises: rows would be lost.
    The last ``keep`` versions stay.
    """
    spark = batch.sparkSession
    have = versions(spark, root)
    if any((r, b) == (run, number) for _, r, b, _ in have):
        return
    if number and not any((r, b) == (run, number - 1) for _, r, b, _ in have):
        raise ValueError(f"{root} has no version of batch {number - 1} of run {run}")
    state = merge.union_states(spark.read.parquet(have[-1][3]), batch) if have else batch
    key = [F.col("area"), F.lower("titulo"), F.lower("fonte")]
    target = f"{root}/v={have[-1][0] + 1 if have else 1:012d}-{run}-{number}"
    merge.fill_missing(state.where(it.retained(as_of, days)), key, FILL, keywords="palavras").write.mode("overwrite").parquet(target)
    for *_, old in have[: max(0, len(have) + 1 - keep)]:
        delete(spark, old)


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The identifier that a stream keeps in its checkpoint as long as that exists."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def run_archive(stream: DataFrame, root: str, checkpoint: str, as_of: datetime, days: int = 7) -> StreamingQuery:
    """Work off all files that are there, batch by batch, and stop."""

    def merged(df: DataFrame, n: int) -> None:
        merge_batch(df, _run_id(df.sparkSession, checkpoint), n, root, as_of, days)

    return stream.writeStream.foreachBatch(merged).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The archive's newest complete version."""
    have = versions(spark, root)
    if not have:
        raise ValueError(f"no complete version at {root}")
    return spark.read.parquet(have[-1][3])
