"""Hard negatives for contrastive training, by product quantisation with stored residual norms.

Vectors are integers. A vector is cut into parts, and each part is stored as the number of the
nearest of a few centres and the norm of the residual that the centre leaves. An anchor's table of
inner products with all centres gives its score with a row as a sum of lookups, and by
Cauchy-Schwarz the true score lies within the sum, over the parts, of the anchor's norm times the
row's residual norm. These bounds are rigorous: they only leave out what cannot be among the best,
or cannot lie in the window, and an exact integer product decides on all others. So the result is
exact whatever the centres are, and these may come from a bounded sample.

Anchors and rows are dealt to blocks, and a task takes a block of anchors and streams a block of
rows past it, keeping the best few of each anchor. Two passes do this: the first finds positives,
the second the negatives in the window of each. A block hands on only its best, and the best over
all blocks are taken with partial ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Components become floor(SCALE * x). Components of LARGEST and more after that take no part: products would leave 64 bits.
SCALE, LARGEST = 256, 1 << 24
#: Components of a part, centres of a part, rows of the sample that gives the centres, rounds of its refinement.
PART, CENTRES, SAMPLE, ROUNDS = 2, 256, 4096, 8
#: Rows and anchors of a block; rows and anchors of one table of scores.
ROW_BLOCK, ANCHOR_BLOCK, ROWS, ANCHORS = 8192, 2048, 2048, 64
#: Positives of an anchor, negatives of a positive, and the window in percent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Room for the rounding of bounds, as a share of their terms.
_SLACK = 1e-9


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, x (whole numbers) of the rows that take part."""
    # a missing or non-finite component fails the comparison or makes it null
    whole = F.transform(vector_col, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")))
    fits = F.forall(vector_col, lambda v: F.coalesce(F.abs(v.cast("double")) * SCALE < LARGEST, F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fits)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), whole.cast("array<int>").alias("x"))


class Codebook:
    """Centres of each part, and codes and residual norms of vectors."""

    def __init__(self, sample: np.ndarray, part: int = PART, centres: int = CENTRES, rounds: int = ROUNDS):
        self.dim, self.part = sample.shape[1], part
        rng = np.random.default_rng(0)
        self.centres = []
        for p in range(0, self.dim, part):
            points = sample[:, p : p + part].astype(np.float64)
            chosen = np.unique(points, axis=0)
            chosen = chosen[np.sort(rng.choice(len(chosen), min(centres, len(chosen)), replace=False))]
            for _ in range(rounds):
                near = self._nearest(points, chosen)
                n = np.bincount(near, minlength=len(chosen))
                sums = np.stack([np.bincount(near, weights=points[:, k], minlength=len(chosen)) for k in range(points.shape[1])], axis=1)
                chosen = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], chosen)
            self.centres.append(chosen)

    @staticmethod
    def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)

    def parts(self, x: np.ndarray) -> Iterator[np.ndarray]:
        return (x[:, p : p + self.part].astype(np.float64) for p in range(0, self.dim, self.part))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and residual norms, (rows, parts) each; norms are rounded up."""
        codes, norms = [], []
        for points, centres in zip(self.parts(x), self.centres):
            near = self._nearest(points, centres)
            codes.append(near.astype(np.uint8))
            norms.append(np.nextafter(np.linalg.norm(points - centres[near], axis=1).astype(np.float32), np.float32(np.inf)))
        return np.stack(codes, axis=1), np.stack(norms, axis=1)

    def bounds(self, anchors: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores of each anchor with each row, (anchors, rows) each."""
        score = np.zeros((len(anchors), len(codes)))
        lengths, size = [], 0.0
        for k, (a, centres) in enumerate(zip(self.parts(anchors), self.centres)):
            table = a @ centres.T
            score += table[:, codes[:, k]]
            lengths.append(np.linalg.norm(a, axis=1))
            size = size + np.abs(table).max(axis=1)
        spread = np.stack(lengths, axis=1) @ norms.T.astype(np.float64) * (1 + _SLACK) + (_SLACK * (1 + size))[:, None]
        return score - spread, score + spread


def trained(rows: DataFrame, dim: int, sample: int = SAMPLE) -> Codebook:
    """A codebook of at most `sample` rows, those of the least hashes of their identifiers. Bounds stay
    rigorous for all others; the sample only settles how tight they are."""
    chosen = rows.select("vec_id", "x").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    return Codebook(_matrix([r.x for r in chosen], dim) if chosen else np.zeros((1, dim), np.int64))


def _matrix(vectors: list, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _packed(rows: DataFrame, book: Codebook) -> DataFrame:
    """vec_id, label, x, codes, norms with the last three as bytes; vectors shorter than dim end in zeros."""

    def run(frames):
        for frame in frames:
            x = _matrix(frame["x"].tolist(), book.dim)
            codes, norms = book.encode(x)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "label": frame["label"], "x": [v.tobytes() for v in x.astype(np.int32)], "codes": [c.tobytes() for c in codes], "norms": [n.tobytes() for n in norms]})

    return rows.select("vec_id", "label", "x").mapInPandas(run, "vec_id long, label long, x binary, codes binary, norms binary")


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, of equal ones those of the least identifiers."""
    return np.lexsort((ids, -scores))[:n]


class Block:
    """Rows of one table of scores."""

    def __init__(self, frame: pd.DataFrame):
        stack = lambda c, kind: np.frombuffer(b"".join(frame[c]), dtype=kind).reshape(len(frame), -1)
        self.id, self.label = frame["vec_id"].to_numpy(), frame["label"].to_numpy()
        self.x, self.codes, self.norms = stack("x", np.int32).astype(np.int64), stack("codes", np.uint8), stack("norms", np.float32)


class Top:
    """The best rows of one anchor whose scores lie from low to high, as far as they have been seen."""

    def __init__(self, n: int, low: float = -np.inf, high: float = np.inf):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def wanted(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Places of the rows that may be among the best, by the bounds of their scores."""
        enough = self.scores[-1] if len(self.scores) == self.n else self.low
        surely = least[(least >= self.low) & (most <= self.high)]
        if len(surely) >= self.n:
            enough = max(enough, np.partition(surely, len(surely) - self.n)[len(surely) - self.n])
        return np.flatnonzero((most >= max(enough, self.low)) & (least <= self.high))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
        keep = _best(scores, ids, self.n)
        self.scores, self.ids = scores[keep], ids[keep]


def _streamed(book: Codebook, tops: Callable[[pd.Series], list[Top]], same: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of frames of rows (cell, side, ...) sorted by cell and side, anchors (side 0) first. It
    gives place, vec_id, score of the best rows for each Top of each anchor, by the anchor's number in its cell."""

    n_rows, n_anchors = ROWS, ANCHORS

    def run(frames):
        at, anchors, found = None, [], []

        def done():
            for a, mine in zip(anchors, found):
                for place, top in enumerate(mine):
                    if len(top.ids):
                        yield pd.DataFrame({"anchor_id": a.vec_id, "place": place, "vec_id": top.ids, "score": top.scores})

        for frame in frames:
            start = 0
            cells, sides = frame["cell"].to_numpy(), frame["side"].to_numpy()
            while start < len(frame):
                if cells[start] != at:
                    yield from done()
                    at, anchors, found = cells[start], [], []
                end = start + int(np.argmax(np.append((cells[start:] != at) | (sides[start:] != sides[start]), True)))
                part = frame.iloc[start:end]
                if sides[start] == 0:
                    anchors += list(part.itertuples(index=False))
                    found += [tops(a) for a in part.itertuples(index=False)]
                else:
                    for k in range(0, len(part), n_rows):
                        rows = Block(part.iloc[k : k + n_rows])
                        for j in range(0, len(anchors), n_anchors):
                            _meet(anchors[j : j + n_anchors], found[j : j + n_anchors], rows)
                start = end
        yield from done()

    def _meet(anchors: list, found: list[list[Top]], rows: Block) -> None:
        x = np.frombuffer(b"".join(a.x for a in anchors), dtype=np.int32).reshape(len(anchors), -1).astype(np.int64)
        least, most = book.bounds(x, rows.codes, rows.norms)
        for k, (a, mine) in enumerate(zip(anchors, found)):
            fits = np.flatnonzero((rows.label == a.label) & (rows.id != a.vec_id) if same else rows.label != a.label)
            if not len(fits) or not mine:
                continue
            low, high = least[k, fits], most[k, fits]
            each = [top.wanted(low, high) for top in mine]
            some = np.unique(np.concatenate(each))
            exact = rows.x[fits[some]] @ x[k]
            for top, places in zip(mine, each):
                here = np.searchsorted(some, places)
                top.add(exact[here], rows.id[fits[places]])

    return run


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Both sides dealt to cells of an anchor block and a row block, sorted by cell with anchors first."""
    a, r = -(-n_anchors // ANCHOR_BLOCK) or 1, -(-n_rows // ROW_BLOCK) or 1
    dealt = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    left = anchors.withColumns({"_a": dealt(a), "_r": each(r), "side": F.lit(0)})
    right = rows.withColumns({"_a": each(a), "_r": dealt(r), "side": F.lit(1)})
    both = left.unionByName(right, allowMissingColumns=True).withColumn("cell", F.col("_a") * r + F.col("_r")).drop("_a", "_r")
    return both.repartition("cell").sortWithinPartitions("cell", "side")


def _ranked(found: DataFrame, by: list[str], n: int, score: Column, tie: str) -> DataFrame:
    """The n rows of highest score of each group, with their rank from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    sample: int = SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that
    the condition `anchors` (over vec_id and label) chooses and each of its best `positives` other
    rows of its label, the best `negatives` rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score. Scores are inner products of floor(256 * x);
    higher ones come first, ties by the smaller identifier.

    Rows with a null identifier, label, vector or component, a component that is not finite, or one
    of 2**16 or more, take no part. Shorter vectors end in zeros. Repeated rows of one identifier are
    rows of their own, but no positives of an anchor of that identifier, and as anchors they are
    one: that of the least label and vector. A positive without negatives in its window gives no
    row; neither does one of negative score, whose window is empty. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = stored(usable(vectors, id_col, vector_col, label_col), "vectors")
    n_rows, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    book = trained(rows, max(dim, 1), sample)
    packed = stored(_packed(rows, book), "quantised")
    chosen = packed.where(anchors).select("vec_id", "label", "x").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    chosen = stored(chosen.select("vec_id", "row.label", "row.x"), "anchors")
    n_anchors = chosen.count()
    found_schema = "anchor_id long, place int, vec_id long, score long"

    near = _cells(chosen, packed, n_anchors, n_rows).mapInPandas(_streamed(book, lambda a: [Top(positives)], same=True), found_schema)
    pairs = _ranked(near, ["anchor_id"], positives, F.col("score"), "vec_id")
    pairs = stored(pairs.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "positives")

    windows = pairs.groupBy("anchor_id").agg(F.array_sort(F.collect_set("positive_score")).alias("windows"))
    asking = chosen.join(windows, chosen["vec_id"] == windows["anchor_id"]).drop("anchor_id")

    def tops(a) -> list[Top]:
        scores = [int(s) for s in a.windows]
        return [Top(negatives, -(-low * s // 100), high * s // 100) for s in scores]

    cells = _cells(asking, packed, n_anchors, n_rows)
    met = cells.mapInPandas(_streamed(book, tops, same=False), found_schema)
    best = _ranked(met, ["anchor_id", "place"], negatives, F.col("score"), "vec_id").select("anchor_id", "place", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    placed = windows.select("anchor_id", F.posexplode("windows").alias("place", "positive_score"))
    return (
        pairs.drop("rank").join(placed, ["anchor_id", "positive_score"]).join(best, ["anchor_id", "place"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
