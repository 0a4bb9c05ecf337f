"""Elements of XML files as rows of their attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_elements(spark: SparkSession, path: str | Sequence[str], tag: str, schema: StructType,
                  split: bool = True, keep: Sequence[str] = (), comments: str = "refuse") -> DataFrame:
    """One row per ``tag`` element at any depth; ``schema`` names the attributes, all text.

    ``keep`` names columns to take from the folder names.

    With ``split`` the file is read as text cut at every ``<``.  That character starts a tag
    and, in well-formed XML, appears nowhere inside one, so each piece is one tag and Spark
    can give parts of one large file to many tasks.  A comment or CDATA section with a ``<`` in it
    may hold what looks like elements.  By default a file that has one is an error;
    ``comments="skip"`` reads the files once more for where such sections begin and end, and
    leaves out the pieces inside them, so they stay split.  ``split=False`` is the XML source,
    one task per file.
    """
    if not split:
        reader = spark.read.format("xml").option("rowTag", tag).option("attributePrefix", "")
        return reader.schema(schema).load(path).select(*schema.names, *keep)
    if comments not in ("refuse", "skip"):
        raise ValueError(f"unknown comments {comments!r}")
    pieces = spark.read.option("lineSep", "<").text(path)
    piece = F.col("value")
    opens = (piece.startswith("!--") & ~piece.contains("-->")) | (piece.startswith("![CDATA[") & ~piece.contains("]]>"))
    wanted = piece.startswith(tag) & piece.rlike(f"^{tag}[\\s/>]")
    hidden = opens
    if comments == "skip":
        hidden = F.lit(False)
        # Pieces of a file are ordered by their block and, inside it, as they are read.
        placed = pieces.select("*", F.col("_metadata.file_path").alias("_file"), F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_at"))
        mine = placed.where(wanted).join(_hidden_ranges(placed, opens), "_file", "left").where(
            ~F.coalesce(F.exists("_ranges", lambda r: (F.col("_at") > r["from"]) & (F.col("_at") <= r["to"])), F.lit(False)))
    else:
        mine = pieces.where(hidden | wanted)
    # Up to the closing bracket; a bracket inside a quoted attribute is not it.
    refused = F.raise_error(F.lit("a comment or CDATA section has a < in it: read the file with comments=\"skip\" or split=False"))
    opening = F.regexp_extract(F.when(hidden, refused.cast("string")).otherwise(F.col("value")), r"""^((?:[^"'>]|"[^"]*"|'[^']*')*)>""", 1)
    element = F.concat(F.lit("<"), F.rtrim(opening, F.lit("/ \t\r\n")), F.lit("/>"))
    parsed = F.from_xml(element, schema.simpleString(), {"attributePrefix": "", "rowTag": tag})
    return mine.select(parsed.alias("_row"), *keep).select("_row.*", *keep)


def _hidden_ranges(placed: DataFrame, opens: Column) -> DataFrame:
    """(_file, _ranges): from the piece that opens a comment or CDATA section to the one that closes it.

    Only pieces that may open or close one are brought together, in their order, and read with what is open as the
    state: what looks like a comment inside a CDATA section is none, and the other way round.
    """
    piece = F.col("value")
    marks = placed.where(opens | piece.contains("-->") | piece.contains("]]>")).select("_file", F.struct(
        "_at", F.when(opens & piece.startswith("!--"), "comment").when(opens, "cdata").alias("opens"),
        piece.contains("-->").alias("ends_comment"), piece.contains("]]>").alias("ends_cdata")).alias("_mark"))
    far = F.struct(F.lit((1 << 63) - 1).alias("block"), F.lit((1 << 63) - 1).alias("row"))
    place = "struct<block: bigint, row: bigint>"
    start = F.struct(F.lit(None).cast("string").alias("open"), F.lit(None).cast(place).alias("since"),
                     F.array().cast(f"array<struct<from: {place}, to: {place}>>").alias("ranges"))

    def step(state: Column, mark: Column) -> Column:
        ends = ((state["open"] == "comment") & mark["ends_comment"]) | ((state["open"] == "cdata") & mark["ends_cdata"])
        closed = F.struct(F.lit(None).cast("string").alias("open"), F.lit(None).cast(place).alias("since"), F.concat(
            state["ranges"], F.array(F.struct(state["since"].alias("from"), mark["_at"].alias("to")))).alias("ranges"))
        opened = F.struct(mark["opens"].alias("open"), mark["_at"].alias("since"), state["ranges"].alias("ranges"))
        return F.when(ends, closed).when(state["open"].isNull() & mark["opens"].isNotNull(), opened).otherwise(state)

    def all_ranges(state: Column) -> Column:
        """A section that is never closed goes on to the end of the file."""
        last = F.array(F.struct(state["since"].alias("from"), far.alias("to")))
        return F.when(state["open"].isNull(), state["ranges"]).otherwise(F.concat(state["ranges"], last))

    listed = marks.groupBy("_file").agg(F.array_sort(F.collect_list("_mark")).alias("_marks"))
    return listed.select("_file", F.aggregate("_marks", start, step, all_ranges).alias("_ranges"))
