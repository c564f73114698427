"""CSV records with line breaks in quoted cells, from files that many tasks read line by line.

A line with an odd number of quotes opens a record that goes on, or closes one; in the order of the file they
take turns. Those lines are few: they are numbered along the file by running totals, and each one
that opens is paired with the one that closes. The lines of such spans are joined to their record's
first line; all others are records as they are, and are not shuffled where spans are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.operators.ordering import numbered
from veilframe.session import sent_if_small, written, written_and_counted, written_and_sized

SPAN_AT_ONCE = 1 << 16
PLACE = "_place"  # file and line of a row


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, text of every line, counted from 0 along each file. Written once, as the place of a line
    follows from the scan."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    lines = written(lines, "csv_lines")
    # One row per block of a file: where its lines begin.
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    blocks, size = written_and_sized(blocks, "csv_blocks")
    placed = lines.join(sent_if_small(blocks, size), ["file", "block"])
    return placed.select("file", (F.col("before") + F.col("id") - F.col("low")).alias("line"), "text")


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, line (of its start) and text of every record; blank lines between records are none.

    Quotes within a quoted cell are doubled, and a cell that holds a quote is quoted. A file that ends
    within quotes ends with the lines as they are. Lines end in \\n or \\r\\n.
    """
    lines = numbered_lines(spark, path)
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    odd, rows = written_and_counted(lines.where(quotes % 2 == 1).select("file", "line"), "csv_odd")
    turns = numbered(odd, ["line"], "turn", ["file"], rows=rows)
    spans = turns.groupBy("file", F.floor((F.col("turn") - 1) / 2).alias("span")).agg(
        F.min("line").alias("start"), F.max("line").alias("end")).where("end > start")
    # A span is laid out in pieces, so that no row holds the numbers of a long one.
    pieces = spans.select("file", "start", "end", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("end") - F.col("start")) / SPAN_AT_ONCE))).alias("piece"))
    low = F.col("start") + F.col("piece") * SPAN_AT_ONCE
    inside = pieces.select("file", "start", F.explode(F.sequence(low, F.least(F.col("end"), low + SPAN_AT_ONCE - 1))).alias("line"))
    inside, size = written_and_sized(inside, "csv_spans")
    marked = lines.join(sent_if_small(inside, size), ["file", "line"], "left")
    ends = F.regexp_replace("text", "\r$", "")
    plain = marked.where("start IS NULL").select("file", "line", ends.alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("line", "text")))
    joined = marked.where("start IS NOT NULL").groupBy("file", "start").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    whole = joined.select("file", F.col("start").alias("line"), ends.alias("text"))
    return plain.where(F.trim("text") != "").unionByName(whole)


def read_quoted(spark: SparkSession, path: str) -> DataFrame:
    """The table of the records, all columns text, and `file` and `line` of each row in a last column.

    The first record of each file is its header; the names are those of the first file.
    """
    found = written(records(spark, path), "csv_records")
    heads = found.groupBy("file").agg(F.min("line").alias("head"))
    heads, size = written_and_sized(heads, "csv_heads")
    first = found.join(sent_if_small(heads, size), "file").where("line = head").orderBy("file").select("text").limit(1)
    options = {"escape": '"', "nullValue": "", "multiLine": "true"}
    header = first.first()
    if header is None:
        return spark.createDataFrame([], f"{PLACE} struct<file: string, line: bigint>")
    # The header read as a row of enough text columns gives the names.
    most = header.text.count(",") + 1
    cells = first.select(F.from_csv("text", ", ".join(f"c{i} string" for i in range(most)), options).alias("r")).select("r.*").first()
    names = [c for c in cells if c is not None]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = found.join(sent_if_small(heads, size), "file").where("line > head")
    return rows.select(F.from_csv("text", schema, options).alias("r"), F.struct("file", "line").alias(PLACE)).select("r.*", PLACE)
