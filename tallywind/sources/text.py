"""Space-delimited text in and out."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.operators.joins import attach
from tallywind.operators.ordering import running_total
from tallywind.schema import LOG_SCHEMA
from tallywind.storage import store


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = " ") -> DataFrame:
    """Delimited text with a header line; pass the schema of the file, fewer columns included."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema or LOG_SCHEMA, enforceSchema=False, mode="FAILFAST")


def read_log_ws(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Like ``read_log`` for columns separated by any run of whitespace."""
    schema = schema or LOG_SCHEMA
    pieces = F.split(F.trim("value"), r"\s+")
    header = list(schema.names)
    rows = spark.read.text(path).select(pieces.alias("p")).filter(F.get("p", F.lit(0)) != header[0])
    return rows.select(*[F.get("p", F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def write_scores(
    df: DataFrame, path: str, id_col: str = "instance_id", score_col: str = "predicted_score", mode: str = "errorifexists"
) -> None:
    """Id and score as space-delimited text with a header in every part file of the folder ``path``."""
    df.select(id_col, score_col).write.csv(path, sep=" ", header=True, mode=mode)


def _places() -> list[Column]:
    """Where a row of a text source stands: its file, the block of it that a task reads, and its turn in the task.

    A block is read from front to back, so the turn gives the order inside it without a look at the content.
    """
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_turn"),
    ]


def read_log_in_order(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = " ", row_number: str = "row_number", **join_options
) -> DataFrame:
    """``read_log`` with the gapless 0-based number of every row: files by name, rows as they stand in them.

    Rows are counted per block of a file and each block adds the rows of those before it, so nothing is sorted but the list
    of blocks. ``dedupe_by(df, keys, ["row_number"])`` keeps the first row of the file.
    """
    rows = read_log(spark, path, schema, sep)
    placed = store(rows.select(*rows.columns, *_places())).df  # a turn is only good for the read that gave it
    blocks = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_turn").alias("_first"))
    offsets = running_total(blocks, ["_file", "_block"], "_n", "_before").select("_file", "_block", "_first", "_before", "_n")
    located = attach(placed, offsets, ["_file", "_block"], weight="_n", spread_by=["_turn"], **join_options)
    return located.select(*rows.columns, (F.col("_before") + F.col("_turn") - F.col("_first")).alias(row_number))


class TooManyRejects(ValueError):
    """More rows of a text source than allowed could not be read."""


def read_log_checked(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = " ", most_rejected: float = 1e-3
) -> tuple[DataFrame, DataFrame]:
    """(rows that parse, rejects) where a reject is (file, line, reason); both are written tables.

    A line with another number of fields, or with a field that is not of its column's type, is a reject and does not end
    the job. A share of more than ``most_rejected`` is an error, which names the table with the rejects' reasons by count.
    """
    schema = schema or LOG_SCHEMA
    bad = "_line"
    asked = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    reader = spark.read.schema(asked).option("columnNameOfCorruptRecord", bad)
    raw = reader.csv(path, sep=sep, header=True, mode="PERMISSIVE", enforceSchema=True)
    kept = store(raw.select(*asked.names, F.col("_metadata.file_path").alias("_file"))).df
    good = kept.where(F.col(bad).isNull()).select(*schema.names)
    fields = F.split(bad, reduce(lambda a, c: a.replace(c, "\\" + c), "|.*+?$^()[]{}", sep))
    count = F.concat(F.size(fields).cast("string"), F.lit(f" fields, not {len(schema.names)}"))
    reason = F.when(F.size(fields) != len(schema.names), count)
    for i, f in enumerate(schema.fields):
        value = F.get(fields, F.lit(i))
        reason = reason.when((value != "") & value.try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name} is "), value))
    rejects = kept.where(F.col(bad).isNotNull()).select(F.col("_file").alias("file"), F.col(bad).alias("line"), reason.otherwise("not readable").alias("reason"))
    rejects = store(rejects)
    total = kept.count()
    if rejects.rows > most_rejected * total:
        shown = rejects.df.groupBy("reason").count().orderBy(F.desc("count"), "reason").limit(5).collect()
        raise TooManyRejects(f"{rejects.rows} of {total} rows of {path}: " + "; ".join(f"{r['count']} with {r['reason']}" for r in shown))
    return good, rejects.df


def _number_text(c: Column) -> Column:
    """A double in the fewest digits that give it back, plain from 1e-4 on and as 1e-05 below."""
    text = c.cast("string")
    digits, power = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", ""), F.split_part(text, F.lit("E-"), F.lit(2))
    small = F.concat(digits, F.lit("e-"), F.lpad(power, 2, "0"))
    fourth = F.concat(F.when(c < 0, "-").otherwise(""), F.lit("0.000"), F.regexp_replace(digits, r"[-.]", ""))
    return F.when(text.endswith("E-4"), fourth).when(text.contains("E-"), small).otherwise(text)


def write_scores_file(df: DataFrame, path: str, id_col: str = "instance_id", score_col: str = "predicted_score", sep: str = " ") -> None:
    """Id and score as one delimited file ``path`` in the order of ids, the header once; an existing file is an error.

    Ranges of ids are sorted and written side by side into a folder beside ``path``. The parts then become one file where they
    are: by the file system's own ``concat`` where it has one (no byte moves), else by appending one part after the other in
    a fixed buffer. No row is collected. Scores are written with the fewest digits that give them back; nulls are empty.
    """
    spark = df.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    at = hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    if fs.exists(at(path)):
        raise FileExistsError(f"{path} exists")
    number = _number_text(F.col(score_col)) if isinstance(df.schema[score_col].dataType, T.DoubleType) else F.col(score_col).cast("string")
    line = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(sep), F.coalesce(number, F.lit("")))
    parts = f"{path}._parts"
    ordered = df.select(id_col, line.alias("value")).repartitionByRange(id_col, "value").sortWithinPartitions(id_col, "value")
    ordered.select("value").write.text(parts)
    spark.createDataFrame([(f"{id_col}{sep}{score_col}",)], "value string").coalesce(1).write.text(f"{parts}/_header")

    listed = [str(f.getPath()) for folder in (f"{parts}/_header", parts) for f in sorted(fs.listStatus(at(folder)), key=lambda f: f.getPath().getName()) if f.getPath().getName().startswith("part-")]
    target = fs.create(at(path), False)
    try:
        target.close()
        sources = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(listed))
        for i, name in enumerate(listed):
            sources[i] = at(name)
        fs.concat(at(path), sources)
    except UnsupportedOperationException:
        target = fs.create(at(path), True)
        for name in listed:
            part = fs.open(at(name))
            hadoop.io.IOUtils.copyBytes(part, target, 1 << 20, False)
            part.close()
        target.close()
    fs.delete(at(parts), True)
