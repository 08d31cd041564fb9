"""Problem 8: mixing sources to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the tokens its source has sent so far, divided by the source's
weight. The mix is all copies in the order of that time, up to the total budget. So each source has its share at every
prefix of the mix, up to one document, as long as it has copies left; when a source has sent each document as often as it
may, the others fill the rest of the budget in proportion to their weights, and the report tells the shares really reached.

Copies are put in order by one range sort. Running sums are never taken over a whole source or over the mix in one task:
documents fall into cells by their shuffle hash (for the sums within a source), and the sorted mix is summed task by task
as it is sorted; cells and tasks are summed first, the short tables of their sums are accumulated, and the running sum within one
starts from its offset.

Cases: a source without documents or without tokens can't take part, and the weights of the others are scaled to sum
to 1 (it is reported with ``actual_share`` 0); documents with null or empty text have no tokens and stay out, as do
documents of null or unlisted sources; rows repeated under one id count as documents of their own only once (the
largest number of tokens counts); a budget above all that may be sent gives all of it; an empty table gives an empty mix and
a report with zeros; ties in the shuffle hash and in finish times are broken by source, id and copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipfold.plans.cut import cut
from clipfold.plans.small import join_small

#: Cells of the hash range per source. Only the width of a window partition depends on them.
CELLS = 4096


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task, the row's place in it and the tokens of its rows so far."""
    task, rows, tokens = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        so_far = tokens + np.cumsum(b.column(b.schema.get_field_index("tokens")).to_numpy())
        place = rows + np.arange(1, len(b) + 1)
        rows, tokens = rows + len(b), int(so_far[-1]) if len(b) else tokens
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(b), task, np.int32)), pa.array(place.astype(np.int64)), pa.array(so_far)], names=[*b.schema.names, "task", "place", "so_far"])


def fair_mix(tokens: DataFrame, weights: DataFrame, total_tokens: int | str | None = None, seed: int = 0, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """The mix and the report.

    ``tokens``: ``doc_id, source, tokens``; ``weights``: ``source, target_share, max_repeats``. Without ``total_tokens``
    the mix is the largest in which every source with documents can hold its share within its repeats; ``"available"`` asks
    for as many tokens as the listed sources have.

    Returns ``(doc_id, source, copy, tokens, finish, position)`` and ``(source, target_share, weight, max_repeats, docs,
    available_tokens, rows_used, mix_tokens, actual_share, capped)``; ``capped``: all its copies are used.
    """
    w = weights.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    docs = (
        tokens.where("tokens > 0").groupBy("doc_id", "source").agg(F.max("tokens").alias("tokens"))
        .join(w, "source", "left_semi")
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
        .withColumn("cell", F.pmod(F.shiftrightunsigned("h", 40), F.lit(cells)).cast("int"))
    )
    docs = cut(docs, "mix-docs")
    cell_sums = docs.groupBy("source", "cell").agg(F.sum("tokens").alias("cell_tokens"), F.count("*").alias("cell_docs"))
    by_source = Window.partitionBy("source").orderBy("cell")
    cell_sums = cut(cell_sums.withColumn("before", F.sum("cell_tokens").over(by_source) - F.col("cell_tokens")), "mix-cells")
    have = cell_sums.groupBy("source").agg(F.sum("cell_tokens").alias("available_tokens"), F.sum("cell_docs").alias("docs"))
    plan = cut(_plan(w.join(have, "source", "left"), total_tokens), "mix-plan")

    timed = (
        join_small(join_small(docs, plan.select("source", "weight", "max_repeats", "available_tokens", "budget", "until"), "source"), cell_sums.select("source", "cell", "before"), ["source", "cell"])
        .withColumn("sent", F.col("before") + F.sum("tokens").over(Window.partitionBy("source", "cell").orderBy("h", "doc_id")))
        .withColumn("rounds", F.least(F.col("max_repeats"), F.ceil(F.col("until") * F.col("weight") / F.col("available_tokens"))).cast("int"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("rounds", F.lit(1)))))
        .withColumn("finish", (F.col("sent") + (F.col("copy") - 1) * F.col("available_tokens")) / F.col("weight"))
        .where(F.col("finish") <= F.col("until") * (1 + 1e-9))
        .select("doc_id", "source", "copy", "tokens", "finish", "budget")
    )
    kind = timed.schema["doc_id"].dataType.simpleString()
    ordered = timed.orderBy("finish", "source", "doc_id", "copy").mapInArrow(
        _summed, f"doc_id {kind}, source string, copy int, tokens bigint, finish double, budget double, task int, place bigint, so_far bigint"
    )
    ordered = cut(ordered, "mix-sorted")
    tasks = ordered.groupBy("task").agg(F.max("place").alias("rows"), F.max("so_far").alias("all"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = tasks.select("task", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("tokens_before"))
    mix = join_small(ordered, offsets, "task").where(F.col("tokens_before") + F.col("so_far") <= F.col("budget") * (1 + 1e-12))
    mix = mix.select("doc_id", "source", "copy", "tokens", "finish", (F.col("rows_before") + F.col("place")).alias("position"))

    used = mix.groupBy("source").agg(F.count("*").alias("rows_used"), F.sum("tokens").alias("mix_tokens"))
    report = plan.join(used, "source", "left").na.fill(0, ["docs", "available_tokens", "rows_used", "mix_tokens"]).na.fill(0.0, ["weight"])
    total = report.agg(F.sum("mix_tokens").alias("all_tokens"))
    report = report.crossJoin(F.broadcast(total)).select(  # total: one row
        "source", "target_share", "weight", "max_repeats", "docs", "available_tokens", "rows_used", "mix_tokens",
        F.when(F.col("all_tokens") > 0, F.col("mix_tokens") / F.col("all_tokens")).otherwise(F.lit(0.0)).alias("actual_share"),
        ((F.col("docs") > 0) & (F.col("rows_used") == F.col("docs") * F.col("max_repeats"))).alias("capped"),
    )
    return mix, report


def _plan(sources: DataFrame, total_tokens: int | str | None) -> DataFrame:
    """``sources`` (one row each) with ``weight``, ``budget``, and ``until``, the virtual time at which the budget is filled.

    At virtual time t a source has sent the less of t times its weight and all its copies, so the sum of what all have sent
    is straight between the times at which one source ends; the budget is reached on one of these pieces.
    """
    live = sources.withColumn("live", F.when(F.col("available_tokens") > 0, F.col("target_share")))
    total = live.agg(F.sum("live").alias("live_sum"))
    plan = live.crossJoin(F.broadcast(total)).withColumn("weight", F.col("live") / F.col("live_sum")).drop("live", "live_sum")  # one row
    plan = plan.withColumn("most", F.col("max_repeats") * F.col("available_tokens")).withColumn("ends", F.col("most") / F.col("weight"))
    if total_tokens is None:
        budget = F.min("ends")
    elif total_tokens == "available":
        budget = F.sum("available_tokens").cast("double")
    else:
        budget = F.lit(float(total_tokens))
    plan = plan.crossJoin(F.broadcast(plan.agg(budget.alias("budget"))))  # one row
    ended = Window.orderBy("ends", "source")  # one row a source
    steps = plan.where("weight is not null").select(
        "ends", "budget", F.coalesce(F.sum("most").over(ended.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("done"), F.sum("weight").over(ended.rowsBetween(0, Window.unboundedFollowing)).alias("open")
    )
    at = F.least(F.col("ends"), (F.col("budget") - F.col("done")) / F.col("open"))
    reached = steps.where(F.col("done") + F.col("open") * F.col("ends") >= F.col("budget") * (1 - 1e-12))
    until = steps.agg(F.max("ends").alias("last")).crossJoin(reached.agg(F.min_by(at, "ends").alias("t"))).select(F.coalesce("t", "last").alias("until"))  # one row each
    return plan.drop("most", "ends").crossJoin(F.broadcast(until))  # one row
