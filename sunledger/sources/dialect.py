"""CSV files whose delimiter and header nobody has stated.

All lines of all files are counted: for each candidate the delimiter's occurrences in a line, outside quotes.  The right one
gives most lines of a file the same number of fields.  A file has a header if exactly one of its lines has neither a number
nor a time in any field while others have; it names the columns then.  Files that agree in both are one input.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.sources.files import with_site

CANDIDATES = (";", ",", "\t", "|")

_NUMBER = r"^\s*-?\d+([.,]\d+)?\s*$"
_TIME = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?)?"


@dataclass(frozen=True)
class Dialect:
    sep: str
    #: names in the files' first lines, None without a header
    header: tuple[str, ...] | None
    #: fields of a line
    width: int


def _occurrences(line: Column, sep: str) -> Column:
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))


def _typed(line: Column, sep: str) -> Column:
    """Whether a field of the line is a number or a time; None where all are empty."""
    fields = F.transform(F.split(line, f"[{sep}]"), lambda x: F.trim(F.translate(x, '"', "")))
    filled = F.filter(fields, lambda x: x != "")
    return F.when(F.size(filled) > 0, F.exists(filled, lambda x: x.rlike(_NUMBER) | x.rlike(_TIME)))


def dialects(spark: SparkSession, paths: str | Sequence[str]) -> dict[Dialect, list[str]]:
    """The files by their dialect; a file without any line is left out.

    What comes to the driver is a row for each file, as its name does when it is read.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    lines = lines.where(F.trim("line") != "")
    tried = F.inline(F.array(*[
        F.struct(F.lit(i).alias("rank"), _occurrences(F.col("line"), s).alias("n"), _typed(F.col("line"), s).alias("typed")) for i, s in enumerate(CANDIDATES)
    ]))
    untyped = ~F.col("typed")
    counted = lines.select("file", "line", tried).groupBy("file", "rank", "n").agg(
        F.count("*").alias("lines"),
        F.count_if("typed").alias("typed"),
        F.count_if(untyped).alias("untyped"),
        F.max(F.when(untyped, F.col("line"))).alias("header"),
    )
    # per candidate the number of fields that most lines have
    usual = counted.groupBy("file", "rank").agg(
        F.max(F.struct("lines", "n", "typed")).alias("top"), F.sum("lines").alias("all"), F.sum("typed").alias("typed"), F.sum("untyped").alias("untyped"), F.max("header").alias("header")
    )
    share = F.when(F.col("top.n") > 0, F.col("top.lines") / F.col("all")).otherwise(0.0)
    best = usual.groupBy("file").agg(F.max(F.struct(share.alias("share"), F.col("top.n").alias("n"), (-F.col("rank")).alias("order"), "typed", "untyped", "header")).alias("b"))
    out: dict[Dialect, list[str]] = defaultdict(list)
    for row in best.select("file", "b.*").collect():
        sep = CANDIDATES[-row["order"]]
        named = row["untyped"] == 1 and row["typed"] > 0
        header = tuple(x.strip() for x in next(csv.reader([row["header"]], delimiter=sep))) if named else None
        out[Dialect(sep, header, row["n"] + 1)].append(row["file"])
    return {d: sorted(files) for d, files in out.items()}


def detected_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files below ``path`` as one input of the columns of ``schema`` (DDL), whatever their delimiter and header.

    Columns are found by their names where a file has a header, so files may order them differently and have others
    besides; without one they are taken in the order of ``schema``.  A named column that a file lacks is NULL.
    """
    wanted = T.StructType.fromDDL(schema)
    parts = []
    for d, files in sorted(dialects(spark, path).items(), key=lambda x: x[1]):
        names = d.header or [f.name for f in wanted.fields[: d.width]] + [f"_more{i}" for i in range(max(d.width - len(wanted), 0))]
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = spark.read.schema(text).options(sep=d.sep, header=d.header is not None, mode="FAILFAST", enforceSchema=False, basePath=path).csv(files)
        cols = [(F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        sited = with_site(raw)
        parts.append(sited.select(*cols, "site_id"))
    if not parts:
        return spark.createDataFrame([], f"{schema}, site_id int")
    return reduce(DataFrame.unionByName, parts)
