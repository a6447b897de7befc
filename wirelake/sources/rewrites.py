"""Taking rows out of a stored table while others read it.

Files are never changed or deleted. A period (day or month) that loses many of its rows is written anew without them, beside
the table, under the number of the rewrite; of one that loses few, the places of these rows are listed, as bits for each
file, so that the cost goes by the rows taken out and not by the rows that stay. Both are committed by one file that names
the rewrite and the files it replaces. A reader first looks for the newest committed rewrite, then lists the files, takes
all but the replaced ones and leaves out the listed places: it sees a table as it was before or as it is after, and rows
that were appended since. One writer at a time takes rows out of a table; others may append meanwhile.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A task gives its files of several days one name, so a file is known by its day and name.
COMMITS = "rewrite long, day date, file string"
MARKS = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_bits", T.ArrayType(T.LongType()))])
REWRITE_SHARE = 0.25  # of a period's rows; what it has lost when it is written anew


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A Parquet folder; null while it isn't there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _commits(spark: SparkSession, table: str) -> tuple[list[int], DataFrame | None]:
    """The numbers of the rewrites so far, and the files that they replaced; null where there are none."""
    commits = _read(spark, f"{table}.commits", COMMITS)
    if commits is None:
        return [], None
    files = {row["rewrite"]: row["n"] for row in commits.groupBy("rewrite").agg(F.count("file").alias("n")).collect()}
    replaced = commits.where(F.col("rewrite").isin(*files) & F.col("file").isNotNull()) if any(files.values()) else None
    return sorted(files), replaced


def _marks(spark: SparkSession, table: str, period: T.StructField, rewrites: list[int]) -> DataFrame | None:
    """The places that these rewrites took out of each file: bit n of `_bits` is that of row n. A later mark of a file includes the earlier."""
    marks = _read(spark, f"{table}.removed", T.StructType([*MARKS.fields, period, T.StructField("rewrite", T.LongType())])) if rewrites else None
    if marks is None:
        return None
    return marks.where(F.col("rewrite").isin(*rewrites)).groupBy(period.name, "_file").agg(F.max_by("_bits", "rewrite").alias("_bits"))


def _stored(spark: SparkSession, table: str, schema: T.StructType, rewrites: list[int], replaced: DataFrame | None) -> DataFrame:
    """The rows of all files that are not replaced, with the file of each (`_file`) and its place there (`_row`)."""
    at = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    base = spark.read.schema(schema).parquet(table).select(*schema.names, *at)
    if replaced is None:
        return base
    numbered = T.StructType([*schema.fields, T.StructField("rewrite", T.LongType())])
    written = spark.read.schema(numbered).parquet(f"{table}.rewrites").where(F.col("rewrite").isin(*rewrites))
    period = schema.names[-1]
    gone = replaced.select(F.col("day").alias(period), F.col("file").alias("_file"))  # a list of files, not of rows
    return base.unionByName(written.select(*schema.names, *at)).join(gone, [period, "_file"], "left_anti")


def _unmarked(rows: DataFrame, marks: DataFrame | None, period: str) -> DataFrame:
    """The rows without those at marked places. A mark is one row for a file, so Spark broadcasts the marks up to its usual bound."""
    if marks is None:
        return rows
    marks = marks.select(F.col(period).alias("_of"), F.col("_file").alias("_in"), "_bits")
    word = F.get("_bits", F.shiftright("_row", 6).cast("int"))
    marked = F.getbit(word, F.col("_row").bitwiseAND(F.lit(63)).cast("int")) == 1
    both = F.col(period).eqNullSafe(F.col("_of")) & (F.col("_file") == F.col("_in"))
    return rows.join(marks, both, "left").where(~F.coalesce(marked, F.lit(False))).select(*rows.columns)


def current_places(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows that readers see now, with the file of each (`_file`) and its place there (`_row`)."""
    rewrites, replaced = _commits(spark, table)  # before the files are listed
    marks = _marks(spark, table, schema.fields[-1], rewrites)
    return _unmarked(_stored(spark, table, schema, rewrites, replaced), marks, schema.names[-1])


def read_current(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of the table, by its committed rewrites. ``schema`` has the partition column last, so days are pruned."""
    return current_places(spark, table, schema).select(*schema.names)


def _bits(places: DataFrame, known: DataFrame | None, period: str) -> DataFrame:
    """One row for each file of `places`: the bits of these and of the known places."""
    of = [period, "_file"]
    word = F.shiftright("_row", 6).cast("int").alias("_word")
    new = places.select(*of, word, F.expr("shiftleft(1L, CAST(_row & 63 AS INT))").alias("_bit"), F.lit(1).alias("_new"))
    new = new.groupBy(*of, "_word").agg(F.bit_or("_bit").alias("_bit"), F.sum("_new").alias("_new"))
    last = new.groupBy(*of).agg(F.max("_word").alias("_last"))
    none = last.select(*of, F.explode(F.sequence(F.lit(0), "_last")).alias("_word"), F.lit(0).cast("long").alias("_bit"), F.lit(0).cast("long").alias("_new"))
    words = new.union(none)
    if known is not None:
        words = words.union(known.select(*of, F.posexplode("_bits").alias("_word", "_bit"), F.lit(0).cast("long").alias("_new")))
    words = words.groupBy(*of, "_word").agg(F.bit_or("_bit").alias("_bit"), F.sum("_new").alias("_new"))
    files = words.groupBy(*of).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_word", "_bit"))), lambda w: w["_bit"]).alias("_bits"),
        F.sum("_new").alias("_new"))
    return files.where("_new > 0").drop("_new")


def take_out(
    spark: SparkSession, table: str, schema: T.StructType, places: DataFrame, write: Callable[[DataFrame, str], int], share: float = REWRITE_SHARE,
) -> int:
    """Takes the rows at ``places`` (period, `_file`, `_row` of `current_places`, each once) out of the table; returns their number.

    A period is written anew once it has lost ``share`` of its rows. ``write`` writes rows to a new path in the layout of
    the table. What fails before the commit changes nothing, and what it left is never read."""
    period = schema.names[-1]
    rewrites, replaced = _commits(spark, table)
    number = max([time.time_ns() // 1000, *[n + 1 for n in rewrites]])  # new, so that what a failed rewrite left is under a number of its own
    places.write.parquet(f"{table}.places/rewrite={number}")
    found = spark.read.schema(places.schema).parquet(f"{table}.places/rewrite={number}")
    taken = found.count()
    if not taken:
        return 0
    _bits(found, _marks(spark, table, schema.fields[-1], rewrites), period).write.partitionBy(period).parquet(f"{table}.removed/rewrite={number}")
    stored = _stored(spark, table, schema, rewrites, replaced)
    marks = _marks(spark, table, schema.fields[-1], [*rewrites, number])
    sizes = stored.groupBy(period).agg(F.count("*").alias("n"))
    left = _unmarked(stored, marks, period).groupBy(period).agg(F.count("*").alias("m"))
    few = sizes.join(left, period, "left").where(F.col("n") - F.coalesce("m", F.lit(0)) >= share * F.col("n"))
    days = [row[period] for row in few.where(F.col(period).isNotNull()).collect()]
    files = []
    if days:
        old = stored.where(F.col(period).isin(*days))
        write(_unmarked(old, marks, period).select(*schema.names), f"{table}.rewrites/rewrite={number}")
        files = [old.select(F.lit(number).cast("long").alias("rewrite"), F.col(period).alias("day"), F.col("_file").alias("file")).distinct()]
    # one file, which appears as a whole; the row without a file is there even if nothing was replaced
    none = spark.range(1).select(F.lit(number).cast("long").alias("rewrite"), F.lit(None).cast("date").alias("day"), F.lit(None).cast("string").alias("file"))
    reduce(DataFrame.union, files, none).coalesce(1).write.mode("append").parquet(f"{table}.commits")
    return taken
