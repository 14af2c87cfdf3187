"""CSV files of any size: read in byte ranges, with quotes and line feeds inside cells.

Spark deals a file's lines out in ranges. Whether a line begins a record or goes on inside a quoted cell is known only
from all lines before it, so each range is read once under both assumptions, and each line notes, for either, the state
before and after it and the line that began its record. A range's effect is that of its last line; from the effects of the
ranges before, each range then gets the assumption that holds, and the record that goes on into it. Records of one line
are parsed where they are; only those of several lines are put together first. No task holds a file.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..plans.durable import materialize, settings
from .adapters import SEPARATOR
from .files import relative_path

#: Most bytes of a record of several lines; more is an error of its file, as a quote that is never closed makes one.
RECORD = 16 << 20
#: Bytes of ranges that a task reads, where ranges are smaller.
TASK = 32 << 20
_INSIDE = re.compile(rb'(?:[^"]|"")*+"')
_LINES = "path string, block long, at long, line binary, s_open boolean, s_after boolean, s_owner long, q_open boolean, q_after boolean, q_owner long"
_NAMES = [c.split()[0] for c in _LINES.split(", ")]
_PARSED = "fuente string, block long, at long, cells array<string>, error string"


@dataclass
class CsvRanges:
    """rows: (fuente, block, at, texto), a row's text and its place, which orders the rows of a file. figures: (fuente,
    num_filas_validas, filas_omitidas_por_formato_invalido, columnas, codificacion_detectada, error). errors: (fuente, error),
    the files that have no rows because of an error."""

    rows: DataFrame
    figures: DataFrame
    errors: DataFrame


def ends_open(line: bytes, inside: bool, delimiter: bytes = b",") -> bool:
    """Whether a quoted cell is open at the line's end; inside: whether one is at its start."""
    if b'"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            m = _INSIDE.match(line, at)
            if m is None:
                return True
            at, inside = m.end(), False
        elif line[at : at + 1] == b'"':
            at, inside = at + 1, True
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += len(delimiter)


def _scanned(delimiter: bytes):
    def scan(batches):
        place, at, state, owner = None, 0, {}, {}
        for batch in batches:
            out = {k: [] for k in ("at", "s_open", "s_after", "s_owner", "q_open", "q_after", "q_owner")}
            columns = (batch.column(c).to_pylist() for c in ("path", "block", "line"))
            for path, block, line in zip(*columns, strict=True):
                if (path, block) != place:  # Spark reads a range's lines in order
                    place, at, state, owner = (path, block), 0, {"s": False, "q": True}, {"s": -1, "q": -1}
                out["at"].append(at)
                for k in "sq":
                    if not state[k]:
                        owner[k] = at
                    out[f"{k}_open"].append(state[k])
                    state[k] = ends_open(line, state[k], delimiter)
                    out[f"{k}_after"].append(state[k])
                    out[f"{k}_owner"].append(owner[k])
                at += 1
            kept = {c: batch.column(c) for c in ("path", "block", "line")}
            typed = {k: pa.array(v, pa.bool_() if "open" in k or "after" in k else pa.int64()) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict({c: (kept | typed)[c] for c in _NAMES})

    return scan


def lines(spark: SparkSession, root: str, delimiter: str = ",", glob: str = "*.csv", size: int | None = None, returns: bool = True) -> DataFrame:
    """_LINES of the files below root, with fuente; written. size: bytes of a range, else as Spark splits files; a task reads many small ones.
    returns: whether carriage returns end lines too."""
    own = {} if size is None else {"spark__sql__files__maxPartitionBytes": str(size)}
    with settings(spark, **own):
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        reader = (reader if returns else reader.option("lineSep", "\n")).text(root)
        path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
        rows = reader.select(path.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
        if size is not None:
            rows = rows.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() * size // TASK)))
        found = rows.mapInArrow(_scanned(delimiter.encode()), _LINES)
        return materialize(found.select(relative_path(spark, root).alias("fuente"), *[c for c in found.columns if c != "path"]))


def _chosen(quoted: Column, name: str) -> Column:
    return F.when(quoted, F.col(f"q_{name}")).otherwise(F.col(f"s_{name}"))


def ranges(found: DataFrame) -> DataFrame:
    """(fuente, block, quoted, from_block, from_at, latin): whether the range begins inside a quoted cell, the record that
    goes on into it, and whether its file isn't UTF-8."""
    last = F.max_by(F.struct("s_after", "s_owner", "q_after", "q_owner"), "at").alias("e")
    valid = F.min(F.is_valid_utf8(F.col("line").cast("string"))).alias("valid")
    effects = found.groupBy("fuente", "block").agg(last, valid).select("fuente", "block", "e.*", "valid")
    # a range's effect on the state is one of four functions: constant, the same, or turned; constants decide, turns since count
    order = Window.partitionBy("fuente").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("s_after") == F.col("q_after"), F.struct("s_after", F.col("turns").alias("turns")))
    turn = (F.col("s_after") & ~F.col("q_after")).cast("int")
    upto = Window.partitionBy("fuente").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    counted = effects.withColumn("turns", F.sum(turn).over(upto))
    seen = counted.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(order), "before": F.coalesce(F.sum(turn).over(order), F.lit(0))})
    since = (F.col("before") - F.coalesce("fixed.turns", F.lit(0))) % 2 == 1
    quoted = F.coalesce("fixed.s_after", F.lit(False)) != since
    stated = seen.withColumn("quoted", quoted).withColumn("owner", _chosen(F.col("quoted"), "owner"))
    own = F.when(F.col("owner") >= 0, F.struct("block", "owner"))
    carried = F.last(own, ignorenulls=True).over(order)
    latin = ~F.min("valid").over(Window.partitionBy("fuente"))
    return stated.withColumn("carried", carried).select(
        "fuente", "block", "quoted", F.col("carried.block").alias("from_block"), F.col("carried.owner").alias("from_at"), latin.alias("latin")
    )


def records(found: DataFrame, states: DataFrame) -> DataFrame:
    """(fuente, block, at, latin, lines, error): records by the place of their first line."""
    placed = found.join(states, ["fuente", "block"])
    quoted, owner = F.col("quoted"), _chosen(F.col("quoted"), "owner")
    placed = placed.select(
        "fuente",
        "latin",
        F.when(owner >= 0, F.col("block")).otherwise(F.col("from_block")).alias("r_block"),
        F.when(owner >= 0, owner).otherwise(F.col("from_at")).alias("r_at"),
        (_chosen(quoted, "open") | _chosen(quoted, "after")).alias("several"),
        "block",
        "at",
        "line"
    )
    single = placed.where("not several").select("fuente", "block", "at", "latin", F.array("line").alias("lines"), F.lit(None).cast("string").alias("error"))
    parts = placed.where("several")
    sizes = parts.groupBy("fuente", "r_block", "r_at").agg(F.sum(F.length("line") + 1).alias("size"))
    large = sizes.where(F.col("size") > RECORD).select("fuente", "r_block", "r_at", F.lit(True).alias("large"))
    sized = parts.join(large, ["fuente", "r_block", "r_at"], "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("large").isNull(), F.struct("block", "at", "line"))))
    whole = sized.groupBy("fuente", "r_block", "r_at").agg(kept.alias("parts"), F.first("latin").alias("latin"), F.max("large").alias("large"))
    joined = whole.select(
        "fuente",
        F.col("r_block").alias("block"),
        F.col("r_at").alias("at"),
        "latin",
        F.transform("parts", lambda p: p["line"]).alias("lines"),
        F.when(F.col("large"), f"ValueError: a record of over {RECORD} bytes").alias("error")
    )
    return single.unionByName(joined)


def _parsed(delimiter: str, longest: int | None):
    def parse(batches):
        before = csv.field_size_limit() if longest is None else csv.field_size_limit(longest)
        try:
            yield from parsed(batches)
        finally:
            csv.field_size_limit(before)  # a worker's next task may be another's

    def parsed(batches):
        for rows in batches:
            cells, errors = [], []
            for held, latin, error in zip(rows["lines"], rows["latin"], rows["error"], strict=True):
                text = "\n".join(bytes(x).decode("latin-1" if latin else "utf-8") for x in held)
                try:
                    cells.append(None if error else next(csv.reader([text], delimiter=delimiter), []))
                except csv.Error as why:
                    cells.append(None)
                    error = f"Error: {why}"
                errors.append(error)
            yield pd.DataFrame({"fuente": rows["fuente"], "block": rows["block"], "at": rows["at"], "cells": cells, "error": errors})

    return parse


def _last_names(batches):
    """Of each header its distinct names, and where each last stands."""
    for rows in batches:
        last = [{name: k for k, name in enumerate(h if h is not None else [])} for h in rows["header"]]
        yield pd.DataFrame({
            "fuente": rows["fuente"],
            "h_block": rows["h_block"],
            "h_at": rows["h_at"],
            "header": rows["header"],
            "names": [[*x] for x in last],
            "places": [[*x.values()] for x in last],
        })


def csv_ranges(
    spark: SparkSession,
    root: str,
    delimiter: str = ",",
    glob: str = "*.csv",
    size: int | None = None,
    longest: int | None = None,
    returns: bool = True,
    told: tuple[str, ...] = (),
) -> CsvRanges:
    """Rows and figures of the CSV files below root, as adapters.csv_file gives them of whole files; records are written once.
    size: bytes of a range; what is written is read again as Spark splits it. Files can be read otherwise than that adapter does:
    longest: characters of a cell at most, if not those of the csv module (131072); returns: False keeps carriage returns inside
    cells as they are; told: columns whose cells are told even if they are blank or nan.

    A file with a record that can't be parsed has no rows but an error. Empty files have no figures, as they have no lines.
    Where a quoted cell is never closed, the file's last line feed is no part of it, as lines don't tell it.
    """
    found = lines(spark, root, delimiter, glob, size, returns)
    states = materialize(ranges(found))
    parsed = materialize(records(found, states).mapInPandas(_parsed(delimiter, longest), _PARSED))
    place = F.struct("block", "at")
    heads = parsed.groupBy("fuente").agg(F.min_by("cells", place).alias("header"), F.min(place).alias("p"), F.min("error").alias("error"))
    errors = heads.select("fuente", "error")
    named = heads.where("error is null").select("fuente", "header", F.col("p.block").alias("h_block"), F.col("p.at").alias("h_at"))
    named = materialize(named.mapInPandas(_last_names, "fuente string, h_block long, h_at long, header array<string>, names array<string>, places array<int>"))
    body = parsed.join(named, "fuente").where("(block <> h_block or at <> h_at) and size(cells) > 0")
    fits = F.size("cells") == F.size("header")
    filled = F.filter(
        F.arrays_zip("names", F.transform("places", lambda k: F.get("cells", k)).alias("v")),
        lambda x: x["names"].isin(*told) | ((strip(x["v"]) != "") & (F.lower(x["v"]) != "nan"))
    )
    text = F.array_join(F.transform(filled, lambda x: F.concat(x["names"], F.lit(": "), x["v"])), SEPARATOR)
    rows = body.where(fits).select("fuente", "block", "at", text.alias("texto")).where("texto <> ''")
    counts = body.groupBy("fuente").agg(F.count_if(fits).alias("valid"), F.count_if(~fits).alias("omitted"))
    coding = states.groupBy("fuente").agg(F.when(F.max("latin"), "latin-1").otherwise("utf-8").alias("codificacion_detectada"))
    figures = errors.join(named, "fuente", "left").join(counts, "fuente", "left").join(coding, "fuente").select(
        "fuente",
        F.coalesce("valid", F.lit(0)).alias("num_filas_validas"),
        F.coalesce("omitted", F.lit(0)).alias("filas_omitidas_por_formato_invalido"),
        F.col("header").alias("columnas"),
        "codificacion_detectada",
        "error"
    )
    return CsvRanges(rows, figures, errors.where("error is not null"))


def csv_documents(found: CsvRanges) -> DataFrame:
    """(fuente, texto): the rows of each file in order, one a line, for files whose text fits in a row."""
    lined = found.rows.groupBy("fuente").agg(F.array_sort(F.collect_list(F.struct("block", "at", "texto"))).alias("l"))
    texts = lined.select("fuente", F.array_join(F.transform("l", lambda x: x["texto"]), "\n").alias("texto"))
    return found.figures.where("error is null").select("fuente").join(texts, "fuente", "left").select("fuente", F.coalesce("texto", F.lit("")).alias("texto"))
