"""Tables, scratch storage and small helpers that the text operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words in every contract: space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Identifiers that may be broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names; a temporary one only for a purely local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written to the shared scratch folder and read back: lineage ends there, so a lost
    executor costs a re-read and not a re-computation."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else the table carries."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that df does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name in taken:
        name += "_"
    return name


def small(ids: DataFrame) -> DataFrame:
    """ids, to be broadcast if they are few enough."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def grouped_frames(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[pd.DataFrame, list[int]]]:
    """Whole groups of equal `by`, several to a frame, with where each begins and the last one's end,
    from frames that come sorted by it. Holds one group and one frame."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        if len(held) > 1 and all(held[0][c].iloc[0] == frame[c].iloc[-1] for c in by):
            continue
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else frame
        keys = [rows[c].to_numpy() for c in by]
        cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        starts = [0, *cuts.tolist()]
        if len(starts) > 1:
            yield rows.iloc[: starts[-1]], starts
        held = [rows.iloc[starts[-1] :]]
    if held:
        rows = pd.concat(held, ignore_index=True)
        yield rows, [0, len(rows)]


def whole_groups(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Each group of equal `by` as one frame, from frames that come sorted by it. Holds one group and one frame."""
    for rows, starts in grouped_frames(frames, by):
        for s, e in zip(starts, starts[1:]):
            yield rows.iloc[s:e]


def carried(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and row: the whole row as one value, so that no name in it can clash with one
    that an operator gives. select("row.*") brings the table back."""
    return documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))


def row_keys(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, ...) with a number key that only rows of the same identifier and text
    share: the identifier, but where rows of one identifier differ in text, all texts but one have
    numbers above all identifiers (these are below 2**61), and texts of null identifiers above those."""
    rows = rows.withColumn("hash", F.xxhash64("text"))
    mixed = rows.groupBy(F.col("doc_id").alias("mixed")).agg(F.min("hash").alias("own"), F.max("hash").alias("last"))
    mixed = stored(mixed.where("mixed IS NOT NULL AND own <> last").drop("last"), "mixed-ids")
    above = lambda n: F.shiftrightunsigned("hash", 64 - n) + F.lit(1 << n)
    rows = rows.join(small(mixed), F.col("doc_id") == F.col("mixed"), "left")
    key = F.when(F.col("doc_id").isNull(), above(62)).when(F.col("own") != F.col("hash"), above(61)).otherwise(F.col("doc_id").cast("long"))
    return rows.withColumn("key", key).drop("hash", "mixed", "own")


def without_rejected(rows: DataFrame, judged: DataFrame, keys: list[str], one: bool = False) -> DataFrame:
    """The tables' rows that carried() put into rows, less those whose keys have rows in judged
    (keys, kept) that are none of them kept. one: of rows that share their keys, one stays."""
    fate = judged.groupBy(*keys).agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    marked = fate.where("NOT kept OR n > 1" if one else "NOT kept")
    marked = stored(marked.select(*[F.col(k).alias(f"of_{k}") for k in keys], "kept"), "rejected")
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    if not one or not marked.where("kept").limit(1).count():
        return rows.join(small(marked.where("NOT kept")), same, "left_anti").select("row.*")
    left = rows.join(small(marked), same, "left")
    once = left.where("kept").dropDuplicates(keys)
    return left.where("kept IS NULL").unionByName(once).select("row.*")
