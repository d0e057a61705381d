"""Tab-separated extracts: NULL is ``\\N``, '' is a value, no quoting, backslash escapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NULL_MARKER
from .datasets import Dataset

# Backslash escapes of the text format.
ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "v": "\v"}
OCTAL, HEX = "^[0-7]{1,3}", "^x([0-9A-Fa-f]{1,2})"


def _unescape(c: Column) -> Column:
    """The text that an escaped one stands for, its bytes as given.

    It is split at escaped backslashes, and each piece at the backslashes that
    are left, so every escape is read once and by itself.  Octal and hex
    escapes are bytes, of which several may make one character: the pieces are
    put together as bytes.
    """
    def byte(digits: Column, base: int) -> Column:
        return F.lpad(F.conv(digits, base, 16), 8, "0").substr(7, 2)

    def decoded(part: Column) -> Column:
        out = F.when(part == "", F.lit("5C"))   # a backslash that ends the text stands for itself
        for letter, sign in ESCAPES.items():
            out = out.when(part.startswith(letter), F.concat(F.hex(F.lit(sign)), F.hex(F.substr(part, F.lit(2)))))
        octal, hexed = F.regexp_extract(part, OCTAL, 0), F.regexp_extract(part, HEX, 1)
        out = out.when(octal != "", F.concat(byte(octal, 8), F.hex(F.substr(part, F.length(octal) + 1))))
        out = out.when(hexed != "", F.concat(byte(hexed, 16), F.hex(F.substr(part, F.length(hexed) + 2))))
        return out.otherwise(F.hex(part))

    def piece(text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, r"\\", -1), lambda part, i: F.when(i == 0, F.hex(part)).otherwise(decoded(part))), "")

    pieces = F.transform(F.split(c, r"\\\\", -1), piece)
    # most texts hold no backslash at all
    return F.when(F.contains(c, F.lit("\\")), F.unhex(F.array_join(pieces, "5C")).cast("string")).otherwise(c)


def _escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for letter, sign in ESCAPES.items():
        out = F.replace(out, F.lit(sign), F.lit("\\" + letter))
    return F.replace(out, F.lit("\u0000"), F.lit("\\000"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files at and anywhere below a path; ``_metadata`` tells whose they are."""
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)


def _line() -> Column:
    return F.rtrim(F.col("value"), F.lit("\r"))


def is_header(dataset: Dataset) -> Column:
    # the cheap prefix test decides for nearly every line
    return F.col("value").startswith(dataset.header) & (F.rtrim(_line()) == dataset.header)


def _fields(raw: DataFrame, dataset: Dataset) -> DataFrame:
    pieces = F.split(_line(), "\t", -1)
    return raw.where(~is_header(dataset)).select(pieces.alias("_f"), "value")


def _typed(dataset: Dataset, safe: bool) -> list[Column]:
    out = []
    for i, f in enumerate(dataset.schema.fields):
        text = F.get(F.col("_f"), F.lit(i))
        value = F.when(text != NULL_MARKER, _unescape(text) if isinstance(f.dataType, T.StringType) else text)
        if isinstance(f.dataType, T.StringType) and not safe:
            value = F.validate_utf8(value)
        if not isinstance(f.dataType, T.StringType):
            value = value.try_cast(f.dataType) if safe else value.cast(f.dataType)
        out.append(value.alias(f.name))
    return out


def scan(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """Typed rows of an extract; a malformed value or row fails the job.

    A gzip file cannot be split, so it is one task: write the scan to parquet
    once (see ``load.load_dataset``) and read that.
    """
    return parse(lines(spark, path), dataset)


def parse(raw: DataFrame, dataset: Dataset) -> DataFrame:
    """Typed rows of an extract's lines; header lines are left out."""
    rows = _fields(raw, dataset)
    width = len(dataset.columns)
    exact = F.when(F.size("_f") == width, F.col("_f")).otherwise(
        F.raise_error(F.concat(F.lit(f"{dataset.name}: expected {width} fields: "), F.col("value"))).cast("array<string>"))
    return rows.withColumn("_f", exact).select(*_typed(dataset, safe=False))


def scan_with_rejects(spark: SparkSession, path: str, dataset: Dataset) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines): wrong field count or a value its type cannot hold."""
    rows = _fields(lines(spark, path), dataset)
    numbers = [(i, f.dataType) for i, f in enumerate(dataset.schema.fields) if not isinstance(f.dataType, T.StringType)]
    good = F.size("_f") == len(dataset.columns)
    for i, kind in numbers:
        text = F.get(F.col("_f"), F.lit(i))
        good = good & ((text == NULL_MARKER) | text.try_cast(kind).isNotNull())
    for i, f in enumerate(dataset.schema.fields):
        if isinstance(f.dataType, T.StringType):
            good = good & F.is_valid_utf8(_unescape(F.get(F.col("_f"), F.lit(i))))
    good = F.coalesce(good, F.lit(False))
    return rows.where(good).select(*_typed(dataset, safe=True)), rows.where(~good).select("value")


def check_headers(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """(file, header, column_count, problem) per file; problem is NULL for a valid header.

    Only the split that starts a file is read for it, and ``first`` inside that
    split is the file's first line.
    """
    raw = lines(spark, path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    tops = raw.where("file_block_start = 0").groupBy(F.col("file_path").alias("file")).agg(F.first("value").alias("header"))
    names = F.split(F.rtrim(F.rtrim(F.col("header"), F.lit("\r"))), "\t", -1)
    want = F.array(*[F.lit(c) for c in dataset.columns])
    size = len(dataset.columns)
    problem = F.when(F.size(names) != size, F.concat(F.lit(f"expected {size} columns, got "), F.size(names).cast("string")))
    problem = problem.when(names != want, F.lit("column names or order differ"))
    return tops.select("file", "header", F.size(names).alias("column_count"), problem.alias("problem"))


def write(df: DataFrame, path: str, dataset: Dataset, compression: str = "gzip") -> None:
    """Write rows in the extract format, every file with the header line."""
    cols = []
    for f in dataset.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            text = c.cast("int").cast("string")
        elif isinstance(f.dataType, T.StringType):
            text = _escape(c)
        else:
            text = c.cast("string")
        cols.append(text.alias(f.name))
    # one text column under the header as its name: fields are joined here; a carriage return is
    # escaped wherever it occurs, so as the separator it is found in no value and nothing is quoted
    joined = reduce(lambda a, b: F.concat(a, F.lit("\t"), b),
                    [F.coalesce(c, F.lit(NULL_MARKER)) for c in [F.col(x) for x in dataset.columns]])
    body = df.select(*cols).select(joined.alias(dataset.header))
    (body.write.option("header", True).option("sep", "\r").option("quote", "").option("escapeQuotes", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "")
     .option("escape", "").option("compression", compression).csv(path))


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A small CSV with a header and declared column types; values that do not fit fail."""
    return spark.read.csv(path, schema=ddl, header=True, enforceSchema=False, mode="FAILFAST")
