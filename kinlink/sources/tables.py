"""Record tables, truth and results as tab-separated text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.text import id_list

COLUMNS = ("entity_id", "business_name", "business_address", "country")
RECORD = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
#: Options of lines, the same for files and for columns of lines; a writer keeps blanks at the edges.
LINES = {"sep": "\t", "quote": '"', "escape": '"'}
WRITTEN = LINES | {"emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _reader(spark: SparkSession):
    return spark.read.options(**LINES, header=True, multiLine=True)


def numbered(scan: DataFrame, name: str = "pos") -> DataFrame:
    """scan, a plain read of files, with each row's place from 0 in the files in order of their paths.

    Row numbers of a task grow without gaps through a split, so a row's place in its split is its number less the split's first, and the
    sizes of the splits before it are added up: only one row for each split is ever sorted. The scan is read twice.
    """
    split = {"_path": "_metadata.file_path", "_block": "_metadata.file_block_start"}
    rows = scan.select("*", *(F.col(c).alias(n) for n, c in split.items())).withColumn("_at", F.monotonically_increasing_id())
    sizes = rows.groupBy(*split).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*split, (before - F.col("_first")).alias("_start"))
    return rows.join(starts, [*split]).select(*(rows[c] for c in scan.columns), (F.col("_at") + F.col("_start")).alias(name))


def record_lines(records: DataFrame) -> DataFrame:
    """(entity_id, line): each record as the line that write_records writes; a null field is empty."""
    return records.select("entity_id", F.to_csv(F.struct(*COLUMNS), WRITTEN).alias("line"))


def records_from_lines(lines: DataFrame) -> DataFrame:
    """The records of a column `line`, as read_records reads them; fields may hold quotes, tabs and line breaks."""
    return lines.select(F.from_csv("line", ", ".join(f"{c} string" for c in COLUMNS), LINES).alias("r")).select("r.*").na.fill("")


def list_lines(lists: DataFrame, name: str) -> DataFrame:
    """(source1_entity_id, line): each row of id_lists as the line that write_id_lists writes."""
    return lists.select("source1_entity_id", F.to_csv(F.struct("source1_entity_id", name), WRITTEN).alias("line"))


def truth_from_lines(lines: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids array) of a column `line`, as read_truth reads them, but for repeated ids."""
    fields = lines.select(F.from_csv("line", "source1_entity_id string, matched_entity_ids string", LINES).alias("r")).select("r.*")
    return fields.na.fill("").withColumn("matched_entity_ids", F.array_distinct(id_list(F.col("matched_entity_ids"))))


def read_records(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """All columns as text; an empty field is '', and NA or null are ordinary text. With position, also pos, the row's place in the files."""
    scan = _reader(spark).schema(RECORD).csv(path)
    return (numbered(scan) if position else scan).na.fill("")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path).select("entity_id")


def read_output(spark: SparkSession, path: str, position: bool = False) -> DataFrame | None:
    """A result file with trimmed headers; None if there is no such file. Missing fields are ''. With position, also _pos, the row's place in the files."""
    try:
        found = _reader(spark).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    found = numbered(found, "_pos") if position else found
    return found.toDF(*(c.strip() for c in found.columns)).na.fill("")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids array), blank entries dropped, repeats once; a file without the second column has no matches.

    Ids are expected once; of repeated ids the last row counts, in the order of the files.
    """
    rows = read_output(spark, path, position=True)
    if rows is None:
        raise FileNotFoundError(path)
    cell = F.col("matched_entity_ids") if "matched_entity_ids" in rows.columns else F.lit("")
    numbered = rows.select("source1_entity_id", F.array_distinct(id_list(cell)).alias("matched_entity_ids"), F.col("_pos").alias("at"))
    return numbered.groupBy("source1_entity_id").agg(F.max_by("matched_entity_ids", "at").alias("matched_entity_ids"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode("matched_entity_ids").alias("candidate_entity_id"))


def _write(df: DataFrame, path: str, files: int | None) -> None:
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").options(**WRITTEN, header=True).csv(path)


def write_records(records: DataFrame, path: str, files: int | None = None) -> None:
    _write(records, path, files)


def id_lists(ids: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """A row for each id of ids (entity_id): the sorted distinct candidates of pairs, joined by commas, '' for none."""
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_set("candidate_entity_id")), ",").alias(name))
    every = ids.select(F.col("entity_id").alias("source1_entity_id"))
    return every.join(lists, "source1_entity_id", "left").withColumn(name, F.coalesce(name, F.lit("")))


def write_id_lists(ids: DataFrame, pairs: DataFrame, name: str, path: str, files: int | None = None) -> None:
    _write(id_lists(ids, pairs, name), path, files)
