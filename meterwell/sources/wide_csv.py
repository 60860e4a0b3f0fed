"""The raw wide CSV."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from meterwell.schemas import MONTHLY_INTS
from meterwell.settings import DEFAULTS, Settings

# Text columns by name prefix; every other measure is a number.
_TEXT_PREFIXES = ("last_date_of_month", "date_of_")


def wide_types(columns: Iterable[str], settings: Settings = DEFAULTS) -> dict[str, t.DataType]:
    """Type of each column, by name alone, for any set of metrics."""
    suffixes = [suffix for suffix, _ in settings.months]
    ints = {"aon", *(m + suffix for m in MONTHLY_INTS for suffix in suffixes)}

    def kind(name: str) -> t.DataType:
        if name == "mobile_number":
            return t.LongType()
        if name == "circle_id" or name.startswith(_TEXT_PREFIXES):
            return t.StringType()
        whole = name in ints or name.endswith("_vbc_3g")
        return t.IntegerType() if whole else t.DoubleType()

    return {name: kind(name) for name in columns}


BAD_CELLS = "_bad_cells"


# First lines fetched at a time.
_OPEN_FILES = 64


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files that have them in this order.

    The driver fetches one buffer of each file, many files at a time, and keeps each
    different header once. A Spark job can't stop after a line without reading the
    file to its end or starting a Python worker anew for each file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    names = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_OPEN_FILES) as pool:
        lines = pool.map(inheritable_thread_target(spark)(first_line), names)
        found: dict[tuple[str, ...], list[str]] = {}
        for name, line in zip(names, lines):
            if line is not None:
                header = tuple(next(csv.reader([line.lstrip("\ufeff")]), ()))
                found.setdefault(header, []).append(unquote(name))
    # The folder itself where one header holds: Spark lists many single paths in a job.
    return {header: [path] for header in found} if len(found) == 1 else found


def _parsed(name: str, kind: t.DataType) -> tuple[str, str | None]:
    """SQL for a cell's value, and for whether text is there that doesn't fit its type."""
    cell = f"nullif(nullif(trim(`{name}`), ''), 'NaN')"
    if isinstance(kind, t.StringType):
        return f"nullif(`{name}`, 'NaN')", None
    number = f"try_cast({cell} AS DOUBLE)"
    if isinstance(kind, t.DoubleType):
        return number, f"{cell} IS NOT NULL AND {number} IS NULL"
    exact = f"try_cast({cell} AS {kind.simpleString()})"
    whole = f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS {kind.simpleString()}) END"
    value = f"nvl({exact}, {whole})" if isinstance(kind, t.LongType) else whole
    return value, f"{cell} IS NOT NULL AND ({value}) IS NULL"


def read_wide_csv(
    spark: SparkSession, path: str, settings: Settings = DEFAULTS, bad_cells: str = "fail"
) -> DataFrame:
    """The wide table from CSV files, columns matched by name, types by name too.

    Files are read by header and united, so files may order their columns differently
    or lack some. There is no inference pass over the data. Whole numbers may be
    written `1` or `1.0`; blank and NaN cells are null. A cell that does not fit its
    column (text in a number, a fraction in a whole number) is never dropped silently:
    `bad_cells` is "fail" to end the read, or "keep" to null it and list the column
    names of such cells in `_bad_cells`.
    """
    if bad_cells not in ("fail", "keep"):
        raise ValueError(f"bad_cells: {bad_cells}")
    headers = _headers(spark, path)
    names = list(dict.fromkeys(name for header in headers for name in header))
    types = wide_types(names, settings)
    parts = []
    for header, files in headers.items():
        text = t.StructType([t.StructField(name, t.StringType()) for name in header])
        raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(files)
        cells = {name: _parsed(name, types[name]) for name in header}
        checks = [f"CASE WHEN {bad} THEN '{name}' END" for name, (_, bad) in cells.items() if bad]
        bad = f"array_compact(array({', '.join(checks) or 'CAST(NULL AS STRING)'}))"
        value = [f"{sql} AS `{name}`" for name, (sql, _) in cells.items()]
        parts.append(raw.selectExpr(*value, f"{bad} AS {BAD_CELLS}"))
    if not parts:
        return spark.createDataFrame([], t.StructType([]))
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if bad_cells == "keep":
        return wide.select(*names, BAD_CELLS)
    message = F.concat(F.lit("cells that do not fit their columns: "), F.array_join(BAD_CELLS, ", "))
    fits = F.when(F.size(BAD_CELLS) > 0, F.raise_error(message)).otherwise(F.lit(True))
    return wide.filter(fits.cast("boolean")).select(*names)


def write_wide_csv(wide: DataFrame, path: str) -> None:
    wide.write.mode("overwrite").option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header and inferred types, for files whose columns the name rule does not fit.

    Inference reads the data once more than needed.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
