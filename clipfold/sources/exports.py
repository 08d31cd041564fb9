"""Exports for people: tables as CSV and spreadsheets, report pages and confirmations."""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import date, datetime
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipfold.functions.dates import first_report
from clipfold.functions.text import escape_html, mask_email
from clipfold.operators import report, series
from clipfold.operators.items import ORDER
from clipfold.plans.cut import cut, delete, file_system, fresh_path
from clipfold.plans.ship import ship
from clipfold.sources.state import exists, join_parts, put

SHEET = ("area", "grupo", "ts", "fonte", "dominio", "titulo", "resumo", "ligacao")
#: Rows that a sheet holds by its format.
SHEET_ROWS = 1_048_575


#: Quotes are doubled, white space stays; null is written apart from the empty text.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "\\N"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(path)


def _bounded(df: DataFrame, most: int, what: str) -> pa.Table:
    table = df.limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ValueError(f"more than {most} rows for one {what}")
    return table


def csv_text(df: DataFrame, most: int = 100_000) -> str:
    """One CSV with a byte-order mark, as spreadsheets want it; refuses more than ``most`` rows."""
    return "﻿" + _bounded(df, most, "file").to_pandas().to_csv(index=False)


def workbook(items: DataFrame, areas: DataFrame, errors: DataFrame) -> dict[str, DataFrame]:
    """The sheets: items (newest first, undated before), counts over all areas, and failures."""
    ordered = items.orderBy(F.desc_nulls_first("ts"), *[c for c in ("run_ord", "feed_ord", "item_id") if c in items.columns]).select(*SHEET)
    counts = series.zero_filled(areas.select("area"), "area", items.groupBy("area").agg(F.count("*").alias("noticias")), "noticias")
    return {"noticias": ordered, "resumo": counts.orderBy("area"), "falhas": errors}


def _column(k: int) -> str:
    name = ""
    while k >= 0:
        name, k = chr(65 + k % 26) + name, k // 26 - 1
    return name


def _cell(at: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        text = v.strftime("%Y-%m-%d %H:%M") if isinstance(v, datetime) else v.isoformat() if isinstance(v, date) else str(v)
        if text.startswith("=COUNTIF("):
            return f'<c r="{at}"><f>{escape(text[1:])}</f></c>'
        text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", " ", text)[:32_767]  # a cell's limit by its format
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f'<c r="{at}"><v>{v}</v></c>'


def _row(i: int, values: Iterable) -> str:
    return f'<row r="{i}">' + "".join(_cell(f"{_column(j)}{i}", v) for j, v in enumerate(values)) + "</row>"


def _table_rows(t: pa.Table) -> str:
    return "".join(_row(i, row) for i, row in enumerate([t.column_names, *zip(*(c.to_pylist() for c in t.columns))], 1))


#: Around the rows of a sheet.
_BEGIN, _END = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>', "</sheetData></worksheet>"


def _contents(names: list[str]) -> dict[str, str]:
    """The files of a spreadsheet besides its sheets."""
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    pack = "http://schemas.openxmlformats.org/package/2006"
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(1, len(names) + 1))
    return {
        "[Content_Types].xml": f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n[:31])}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pack}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1)) + "</Relationships>",
    }


def xlsx(sheets: dict[str, pa.Table]) -> bytes:
    """A spreadsheet file of tables; a text that begins with ``=COUNTIF(`` becomes that formula."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in _contents(list(sheets)).items():
            z.writestr(name, body)
        for k, t in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{k}.xml", _BEGIN + _table_rows(t) + _END)
    return out.getvalue()


def _written_rows(df: DataFrame, most: int) -> tuple[int, str]:
    """How many rows an ordered table has, and a folder with the XML of its rows in their order, by sheets of ``most`` rows; tasks write it."""
    spark = df.sparkSession
    ship(spark)
    placed = cut(df.withColumn("__at", F.monotonically_increasing_id()), "sheet")
    tasks = placed.groupBy(F.shiftright("__at", 33).alias("task")).count().orderBy("task").collect()  # a row a task
    before = dict(zip((r.task for r in tasks), itertools.accumulate((r["count"] for r in tasks), initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = [before[at >> 33] + (at & ((1 << 33) - 1)) for at in b.column(b.num_columns - 1).to_pylist()]
            rows = [_row(n % most + 2, values) for n, *values in zip(places, *(c.to_pylist() for c in b.columns[:-1]))]
            yield pa.RecordBatch.from_arrays([pa.array([n // most for n in places], pa.int64()), pa.array(places, pa.int64()), pa.array(rows, pa.string())], names=["sheet", "place", "value"])

    path = fresh_path(spark, "rows")
    rows = cut(placed.mapInArrow(run, "sheet bigint, place bigint, value string"), "cells")
    rows.orderBy("sheet", "place").select("sheet", "value").write.partitionBy("sheet").text(path, compression="gzip", lineSep="\n")
    return sum(r["count"] for r in tasks), path


def write_xlsx(df: DataFrame, path: str, name: str = "dados", most: int = SHEET_ROWS) -> None:
    """A table as a spreadsheet of one sheet; refuses more rows than a sheet holds."""
    put(df.sparkSession, path, xlsx({name: _bounded(df, most, "sheet")}))


def write_workbook(items: DataFrame, areas: DataFrame, errors: DataFrame, path: str, most: int = SHEET_ROWS) -> None:
    """The workbook as a file, in which the counts by area are formulas over the sheet of items.

    Items beyond the ``most`` that a sheet holds go on in sheets of their own at the end (``noticias 2`` and so on), which the
    formulas count too.
    """
    spark = items.sparkSession
    items = cut(items.select(*[c for c in items.columns if c in (*SHEET, *ORDER)]), "book")  # read for the sheet and for the counts
    book = workbook(items, areas, errors)
    counts, failures = (_bounded(book[name], most, "sheet") for name in ("resumo", "falhas"))
    n, rows = _written_rows(book["noticias"], most)
    held = [min(most, n - k) for k in range(0, max(n, 1), most)]
    ranges = [f"{f"'noticias {k}'" if k > 1 else 'noticias'}!$A$2:$A${max(2, here + 1)}" for k, here in enumerate(held, 1)]
    live = ["=" + "+".join(f"COUNTIF({r},A{i})" for r in ranges) for i in range(2, counts.num_rows + 2)]
    sheets: dict[str, str | int] = {"noticias": 0, "resumo": _table_rows(counts.append_column("actual", pa.array(live, pa.string())))}
    if failures.num_rows:
        sheets["falhas"] = _table_rows(failures)
    sheets |= {f"noticias {k}": k - 1 for k in range(2, len(held) + 1)}
    java = spark._jvm.java.util.zip
    p, fs = file_system(spark, path)
    z = java.ZipOutputStream(fs.create(p, True))
    try:
        for name, body in _contents(list(sheets)).items():
            z.putNextEntry(java.ZipEntry(name))
            z.write(bytearray(body.encode()))
        for k, body in enumerate(sheets.values(), 1):
            z.putNextEntry(java.ZipEntry(f"xl/worksheets/sheet{k}.xml"))
            z.write(bytearray((_BEGIN + (_row(1, SHEET) if isinstance(body, int) else body)).encode()))
            if isinstance(body, int) and exists(spark, f"{rows}/sheet={body}"):
                join_parts(spark, f"{rows}/sheet={body}", z)
            z.write(bytearray(_END.encode()))
    finally:
        z.close()
    delete(spark, rows)


def read_sheet(spark: SparkSession, path: str, number: int = 1) -> DataFrame:
    """The cells of a sheet as text: ``linha, coluna, valor``."""

    def cells(batches):
        for b in batches:
            for body in b.column(0).to_pylist():
                xml = zipfile.ZipFile(io.BytesIO(body)).read(f"xl/worksheets/sheet{number}.xml").decode("utf-8")
                found = re.findall(r'<c r="([A-Z]+)(\d+)"[^>]*>(?:<is><t[^>]*>(.*?)</t></is>|<v>(.*?)</v>|<f>(.*?)</f>)</c>', xml, re.S)
                back = lambda s: s.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(r) for _, r, *_ in found], pa.int32()), pa.array([c for c, *_ in found], pa.string()), pa.array([back(t or v or f) for _, _, t, v, f in found], pa.string())], names=["linha", "coluna", "valor"]
                )

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(cells, "linha int, coluna string, valor string")


def with_syntheses(reports: DataFrame, syntheses: DataFrame, as_of: datetime, window: str) -> DataFrame:
    """Area reports with ``sintese``, the HTML of those syntheses that are fresh and of the same window."""
    block = report.syntheses_by_area(syntheses, as_of, window)
    return reports.join(block.select("area", F.col("sintese_html").alias("sintese")), "area", "left").withColumn("sintese", F.coalesce("sintese", F.lit("")))


def confirmations(changed: DataFrame, moment: datetime, cancelled: bool = False, panel: str = "") -> DataFrame:
    """``email, para, assunto, texto, html``: which areas an address now gets, or no longer gets, and when the first report comes."""
    g = changed.groupBy("email").agg(F.array_sort(F.collect_set("area")).alias("areas"))  # at most all areas
    subject = "Subscrição cancelada" if cancelled else "Subscrição confirmada"
    when = F.lit(None).cast("string") if cancelled else F.concat(F.lit("O primeiro relatório chega "), first_report(F.lit(moment)), F.lit("."))
    body = F.concat_ws(" ", F.lit("Deixa de receber os relatórios destas áreas." if cancelled else "Passa a receber um relatório de cada uma destas áreas."), when)
    n = report.plural(F.size("areas"), "área", "áreas")
    made = F.lit(f"Registado em {moment:%d/%m/%Y} às {moment:%H:%M}.")
    text = F.concat_ws("\n", F.lit(subject.upper()), F.lit(""), body, F.lit(""), F.concat(n, F.lit(":")), F.array_join(F.transform("areas", lambda a: F.concat(F.lit("  - "), a)), "\n"), F.lit(f"Painel: {panel}") if panel else F.lit(None).cast("string"), made)
    listed = F.array_join(F.transform("areas", lambda a: F.concat(F.lit("<li>"), escape_html(a), F.lit("</li>"))), "")
    link = F.concat(F.lit('<p><a href="'), escape_html(F.lit(panel)), F.lit('">Abrir o painel</a></p>')) if panel else F.lit("")
    html = F.concat(F.lit(f"<h1>{subject}</h1><p>"), body, F.lit("</p><h2>"), n, F.lit("</h2><ul>"), listed, F.lit("</ul>"), link, F.lit("<p><small>"), made, F.lit("</small></p>"))
    return g.select("email", mask_email("email").alias("para"), F.lit(subject).alias("assunto"), text.alias("texto"), html.alias("html"))
