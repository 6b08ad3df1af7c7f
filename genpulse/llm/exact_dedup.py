"""Exact deduplication by content sort.

Rows are range-partitioned by sampled splitters over (opening characters, digest, slice), sorted
by their whole content inside each range, and every row is compared in full with its neighbour.
The splitters hold only the opening characters and the digest, so their size doesn't depend on
the length of the texts; the comparison reads whole texts.

A group of copies may hold a third of all rows. The slice, a hash of the identifier, divides
every group over up to `slices` sort groups, and the results of the slices are brought together
in rows without text: at most one for each group and slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, only, stored, without_rejected

#: Parts into which one group of copies is divided, and characters of a text that a splitter holds.
SLICES, SPLITTER_CHARS = 64, 64


def exact_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", slices: int = SLICES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    keep: "max" or "min", the identifier that stays of each group of identical texts.
    A null text counts as the empty text. Rows that repeat both identifier and text count in
    group_size, and one of them stays. A null identifier is never chosen while the group has
    another; in a group of null identifiers one row stays, under a null keep_id. An empty table
    gives an empty result. Other columns are ignored.
    """
    rows = only(documents, id_col, text_col).select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("content"),
    )
    rows = rows.withColumns(
        {
            "digest": F.unhex(F.sha2("content", 256)),
            "opening": F.substring("content", 1, SPLITTER_CHARS),
            "slice": F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int"),
        }
    )
    place = Window.partitionBy("opening", "digest", "slice").orderBy("content", "doc_id")
    differs = F.when(F.lag("content").over(place) == F.col("content"), 0).otherwise(1)
    repeats = F.lag("doc_id").over(place).eqNullSafe(F.col("doc_id")) & (F.col("differs") == 0)
    sorted_rows = (
        rows.repartitionByRange("opening", "digest", "slice")
        .withColumn("differs", differs)
        .withColumns({"run": F.sum("differs").over(place).cast("int"), "repeats": repeats})
        .select("doc_id", "digest", "slice", "run", "repeats")
    )
    sorted_rows = stored(sorted_rows, "content-sort")

    key = ["digest", "run"]
    best = {"max": F.max, "min": F.min}[keep]
    parts = sorted_rows.groupBy(*key, "slice").agg(best("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*key)
    totals = parts.select(*key, "slice", best("best").over(group).alias("keep_id"), F.sum("n").over(group).alias("group_size"))
    return sorted_rows.join(totals, [*key, "slice"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("repeats")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def one_of_equals(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """documents, all columns, with one document of each group of identical texts."""
    rows = carried(documents, id_col, text_col).withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    judged = exact_groups(documents, id_col, text_col, keep).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    return without_rejected(rows, judged, ["doc_id", "digest"], one=True)
