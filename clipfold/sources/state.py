"""Persisted state: snapshots, rolling archives, permanent months and daily series as JSON, and plain tables."""

from __future__ import annotations

import json
import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipfold.functions.dates import MONTHS, parse_minute
from clipfold.functions.text import blank
from clipfold.operators import merge
from clipfold.plans.cut import cut, delete, file_system, fresh_path

ITEM = "area string, grupo string, data string, fonte string, dominio string, titulo string, resumo string, ligacao string, palavras array<string>, imagem string"
SERIES = "data string, areas map<string, struct<noticias:bigint, novas:bigint, fontes:bigint, origens:map<string,bigint>, palavras:map<string,bigint>>>"


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: str, reader=None, on_corrupt: str = "raise") -> DataFrame:
    """The state at ``path``; an empty table where there is none. Unreadable state raises unless ``on_corrupt='empty'``."""
    empty = spark.createDataFrame([], schema)
    if not exists(spark, path):
        return empty
    try:
        df = (reader or spark.read.schema(schema).parquet)(path)
        df.limit(1).collect()
        return df
    except Exception:
        if on_corrupt == "empty":
            return empty
        raise


#: Bytes of a document in which its first line, and of its end, are looked for.
HEAD, TAIL = 1 << 16, 64


def _opening(spark: SparkSession, path: str, field: str) -> str | None:
    """The first line of a document that has each of its items on a line of its own, as ``write_document`` makes them; None for others."""
    p, fs = file_system(spark, _literal(path))
    p = fs.globStatus(p)[0].getPath()

    def part(at: int, n: int) -> bytes:
        f = fs.open(p)
        try:
            f.seek(at)
            return bytes(f.readNBytes(n))
        finally:
            f.close()

    first, _, rest = part(0, HEAD).partition(b"\n")
    if not first.rstrip().endswith(b"[") or not re.search(rb"\n[ \t]*\][ \t]*\}\s*$", part(max(0, fs.getFileStatus(p).getLen() - TAIL), TAIL)):
        return None
    try:
        opening = first.decode().rstrip()
        if list(json.loads(opening + "]}").items())[-1] != (field, []):
            return None
        second, ended, _ = rest.partition(b"\n")
        second = second.strip().strip(b",")
        whole = not ended or second.startswith(b"]") or isinstance(json.loads(second), dict)
    except ValueError:
        return None
    return opening if whole else None


def _literal(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _documents(spark: SparkSession, path: str, field: str) -> dict[str, str | None]:
    """The files of ``path``, each with its ``_opening``."""
    return {r.path: _opening(spark, r.path, field) for r in spark.read.format("binaryFile").load(path).select("path").collect()}  # names alone are read


def read_items(spark: SparkSession, path: str, field: str = "noticias") -> DataFrame:
    """Items of whole-file documents ``{..., noticias: [...]}``; missing keys are null, a missing array is empty.

    Documents that have each item on a line are read line by line, in as many tasks as their size needs; any other is read
    whole, by one task. A line that is no JSON raises.
    """
    doc = T.StructType([T.StructField(field, T.ArrayType(T.StructType.fromDDL(ITEM)))])
    files = _documents(spark, path, field)
    lined = [f for f, opening in files.items() if opening is not None]
    mixed = 0 < len(lined) < len(files)
    out = []
    if len(lined) < len(files):
        rest = [_literal(f) for f in files if f not in lined] if mixed else path
        out.append(spark.read.schema(doc).json(rest, multiLine=True).select(F.inline(field)))
    if lined or not files:
        lines = spark.read.text([_literal(f) for f in lined] if mixed else path).select(F.btrim("value", F.lit(" ,\t\r")).alias("line"))
        lines = lines.where((F.col("line") != "") & ~F.endswith("line", F.lit("[")) & ~F.startswith("line", F.lit("]")))
        item = lines.select("line", F.inline(F.array(F.from_json("line", ITEM + ", __bad string", {"columnNameOfCorruptRecord": "__bad"}))))
        bad = F.col("__bad").isNotNull() & F.get_json_object("line", "$").isNull()  # a value of another type is null, as in whole documents
        out.append(item.where(F.when(bad, F.raise_error(F.concat(F.lit("no item: "), F.substring("line", 1, 200))).cast("boolean")).otherwise(True)).drop("line", "__bad"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def read_header(spark: SparkSession, path: str, schema: str, field: str = "noticias") -> DataFrame:
    """The headers of documents, a row each; items are not read where each has its line."""
    files = _documents(spark, path, field)
    rows = [(opening + "]}",) for opening in files.values() if opening is not None]
    out = spark.createDataFrame(rows, "value string").select(F.from_json("value", schema).alias("d")).select("d.*")
    rest = [_literal(f) for f, opening in files.items() if opening is None]
    return out.unionByName(spark.read.schema(schema).json(rest, multiLine=True)) if rest else out


def read_month(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Items of JSON Lines, compressed or not; malformed lines raise, or are left out where ``strict`` is false."""
    return spark.read.schema(ITEM).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """``data, areas`` of the documents ``{dias: [...]}``."""
    doc = T.StructType([T.StructField("dias", T.ArrayType(T.StructType.fromDDL(SERIES)))])
    return spark.read.schema(doc).json(path, multiLine=True).select(F.inline("dias")).withColumn("data", F.to_date("data"))


def _plain(items: DataFrame, *more: str) -> DataFrame:
    cols = [c.strip().split(" ")[0] for c in ITEM.split(",") if c.strip().split(" ")[0] in items.columns or c.strip().startswith("data")]
    return items.withColumn("data", F.date_format("ts", "yyyy-MM-dd HH:mm") if "ts" in items.columns else F.col("data")).select(*cols, *more)


def write_items(items: DataFrame, path: str) -> None:
    """One JSON object a line, in parts; the form for any size."""
    _plain(items).write.mode("overwrite").json(path)


def document(items: DataFrame, made: datetime, header: dict, most: int = 200_000) -> str:
    """A document with a header and all items, newest first, as a text in the driver's memory.

    Refuses more than ``most`` items: ``write_document`` writes any number.
    """
    rows = _newest(items).limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} items for one text")
    return json.dumps(_header(header, made) | {"noticias": [json.loads(r) for r in rows]}, ensure_ascii=False)


def _header(header: dict, made: datetime) -> dict:
    return header | {"atualizado": made.strftime("%Y-%m-%d %H:%M")}


def _newest(items: DataFrame) -> DataFrame:
    return _plain(items).orderBy(F.desc_nulls_last("data"), "titulo")


def write_document(items: DataFrame, path: str, made: datetime, header: dict) -> None:
    """A single document with a header and all items, newest first, for clients that read a whole file.

    Each item has a line. Tasks write them in order, and the bytes of their parts are joined into the file; the driver holds none.
    """
    spark = items.sparkSession
    parts = fresh_path(spark, "document")
    _newest(items).select(F.concat(F.lit(","), F.to_json(F.struct("*"))).alias("value")).write.text(parts, compression="gzip", lineSep="\n")
    p, fs = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray((json.dumps(_header(header, made), ensure_ascii=False)[:-1] + ', "noticias": [\n').encode()))
        join_parts(spark, parts, out, 1)  # no comma before the first item
        out.write(bytearray(b"]}\n"))
    finally:
        out.close()
    delete(spark, parts)


def join_parts(spark: SparkSession, folder: str, out, skip: int = 0) -> None:
    """The text of a table's gzip files, in the order of its tasks and without the first ``skip`` bytes, into a Java stream."""
    at, fs = file_system(spark, folder)
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-") and s.getLen()]
    for part in sorted(found, key=lambda x: (len(x.getName()), x.getName())):
        source = spark._jvm.java.util.zip.GZIPInputStream(fs.open(part), 1 << 16)
        try:
            while skip and source.read() != -1:
                skip -= 1
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
        finally:
            source.close()


def series_document(nested: DataFrame, made: datetime, most: int = 20_000) -> str:
    """The daily series (``data, areas``) as one document, by date; refuses more than ``most`` days."""
    rows = nested.select(F.date_format("data", "yyyy-MM-dd").alias("data"), "areas").orderBy("data").limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} days for one document")
    return json.dumps({"atualizado": made.strftime("%Y-%m-%d %H:%M"), "dias": [json.loads(r) for r in rows]}, ensure_ascii=False)


def append_months(items: DataFrame, path: str, parts: int = 8) -> DataFrame:
    """Add items to the permanent archive (gzip JSON Lines by month of publication) whose area and title it doesn't have.

    Files are only ever added, to the months that gain rows, ``parts`` at most to a month; a run that is repeated finds its
    rows there and adds none. Returns the rows that were new.
    """
    spark = items.sparkSession
    dated = items.where("ts is not null").withColumn("mes", F.date_format("ts", "yyyy-MM"))
    new = _plain(dated, "mes")
    old = read_or_empty(spark, path, ITEM + ", mes string", lambda p: spark.read.schema(ITEM + ", mes string").json(p))
    old = old.join(F.broadcast(new.select("mes").distinct()), "mes", "left_semi")  # months of one run, bounded by the calendar; prunes partitions
    key = lambda df: df.withColumn("__t", F.lower(blank("titulo"))).withColumn("__a", blank("area"))
    fresh = cut(merge.append_new(key(old), key(new), ["mes", "__a", "__t"]).drop("__t", "__a"), "months")
    spread = fresh.repartition("mes", F.pmod(F.xxhash64("area", "titulo"), F.lit(parts)))
    spread.sortWithinPartitions("mes", F.desc("data")).write.mode("append").option("compression", "gzip").partitionBy("mes").json(path)
    return fresh


def long_stamp(moment: datetime) -> str:
    """A time in words, as documents for people carry it."""
    return f"{moment.day} de {MONTHS[moment.month - 1]} de {moment.year}, {moment:%Hh%M}"


def write_snapshot(items: DataFrame, path: str, made: datetime, window: str, origin: str) -> None:
    """The document of one run: a header with its time in words, its origin and window, and all items."""
    write_document(items, path, made, {"gerado": long_stamp(made), "origem": origin, "periodo": window or "sem limite"})


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small file, wherever ``path`` is."""
    p, fs = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def parse_items(raw: DataFrame) -> DataFrame:
    """Persisted items with ``ts`` in place of ``data``."""
    return raw.withColumn("ts", parse_minute("data")).drop("data")
