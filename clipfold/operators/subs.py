"""Subscribers: a set of (area, address) pairs, idempotent insert and delete, masked listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipfold.functions.text import email_key, mask_email


def cleaned(subs: DataFrame) -> DataFrame:
    """Distinct pairs with valid, trimmed, lower-cased addresses."""
    return subs.select("area", email_key("email").alias("email")).where("area is not null and area <> '' and email is not null").distinct()


def subscribe(subs: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The set with ``new``, and the pairs that weren't in it."""
    have, add = cleaned(subs), cleaned(new)
    added = add.join(have, ["area", "email"], "left_anti")
    return have.unionByName(added), added


def cancel(subs: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The set without ``gone``, and the pairs taken out."""
    have, out = cleaned(subs), cleaned(gone)
    return have.join(out, ["area", "email"], "left_anti"), have.join(out, ["area", "email"], "left_semi")


def masked(subs: DataFrame) -> DataFrame:
    """``email, areas``: masked addresses with their number of areas."""
    return cleaned(subs).groupBy("email").agg(F.count("*").alias("areas")).select(mask_email("email").alias("email"), "areas")


def gate(areas_with_items: DataFrame, subs: DataFrame) -> DataFrame:
    """Areas to report on: those with an address; all of them while no address is known at all."""
    have = cleaned(subs)
    known = have.agg((F.count("*") > 0).alias("known"))
    marked = areas_with_items.join(have.select("area").distinct().withColumn("has", F.lit(True)), "area", "left").crossJoin(F.broadcast(known))  # one row
    return marked.where(~F.col("known") | F.coalesce("has", F.lit(False))).select("area")


def recipients(subs: DataFrame) -> DataFrame:
    """``area, para, n``: the addresses of each area as one line for the mailer, in order."""
    g = cleaned(subs).groupBy("area").agg(F.array_sort(F.collect_list("email")).alias("e"))  # one message's addresses
    return g.select("area", F.array_join("e", ",").alias("para"), F.size("e").cast("bigint").alias("n"))


#: Fixed value: how a log is told to hide a text.
HIDE = "::add-mask::"


def hidden(subs: DataFrame) -> DataFrame:
    """``linha``: what to write to a log first, so that it shows no address."""
    return cleaned(subs).select(F.concat(F.lit(HIDE), "email").alias("linha")).distinct()
