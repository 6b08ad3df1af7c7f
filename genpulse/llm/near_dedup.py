"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with the same shingle set are one node. A node's signature is cut into trees, each a
sequence of MinHashes read as a sorting key. In each tree's sorted order, nodes whose keys have
the first BASE hashes in common form a region, and neighbours in a region are candidates. Links
are confirmed on full shingle sets.

Candidates come in three rounds. The first takes sorted neighbours, and confirms each node's best
candidate only: that unites nearly all groups at linear cost, however large they are. The second
compares, in every region that still holds several components, all nodes across components; a
region of more than CROWD rows is taken deeper, part by part, until each part has fewer. What a
crowd loses by that, or holds under equal keys, the third round finds exactly: nodes of crowds
meet under their rarest shingles, of which two linked sets have one in common.

Cells are divided into blocks, and each pair of blocks is a small task of its own that takes both
blocks' sets and hands out only links that unite components: no table of pairs is made. Pairs
within one component need no test, as they change no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, only, row_keys, small, stored, whole_groups, without_rejected
from .components import components, in_blocks, united

#: Words of a shingle; percent of the union that two sets share at least.
WORDS, PERCENT = 5, 75
#: Trees, hashes of a tree's key, hashes that a region shares at least.
TREES, DEPTH, BASE = 20, 8, 4
#: Sorted neighbours of the first round; rows of a region that are sorted in one task there.
NEIGHBOURS, SORTED_ROWS = 3, 4096
#: Rows of a region that are compared at one depth; a region of more is a crowd and is taken deeper.
CROWD = 2048
#: Hashes of two signatures that agree at least before full sets are compared. At a similarity of 0.75
#: 120 of 160 are expected, and fewer than 100 agree with probability 0.0002.
AGREE = 100
_HASH_BYTES, _SEED = 2, 20_011
_KNOWN_WORDS, _BATCH_CHARS = 150_000, 400_000


class Shingler:
    """64-bit shingle sets of texts. Words are hashed once each, up to a bounded number."""

    def __init__(self, words: int = WORDS):
        rng = np.random.default_rng(_SEED)
        self.words, self.known = words, {}
        self.factors = rng.integers(1 << 40, 1 << 63, size=words, dtype=np.uint64) | np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII case and white space
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > _KNOWN_WORDS:
            self.known = {}
        known = self.known
        known.update((w, xxh3_64_intdigest(w)) for w in set(words) if w not in known)
        h = np.array([known[w] for w in words], dtype=np.uint64)
        n = min(len(h), self.words)
        mixed = np.full(len(h) - n + 1, np.uint64(n if n < self.words else 0))
        for k in range(n):
            mixed += h[k : k + len(mixed)] * self.factors[k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def _signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(documents, hashes) low bits of the least hash; sets must not be empty."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), len(a)), dtype=">u2")
    for k in range(len(a)):
        v = flat * a[k]
        v += b[k]
        out[:, k] = (np.minimum.reduceat(v, starts) >> np.uint64(8)).astype(np.uint16)
    return out


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for frame in frames:
        for i, t in zip(frame["doc_id"], frame["text"]):
            ids.append(None if pd.isna(i) else int(i))
            texts.append(t or "")
            held += len(texts[-1])
            if held >= _BATCH_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def sketches(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest (of the shingle set) and signature of every row; the last two
    are null for a text without words."""

    def run(frames):
        from xxhash import xxh3_128_digest

        shingles = Shingler()
        rng = np.random.default_rng(_SEED + 1)
        a = rng.integers(0, 1 << 63, size=TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 1 << 63, size=TREES * DEPTH, dtype=np.uint64)
        for ids, texts in _chunks(frames):
            sets = [shingles(t) for t in texts]
            full = [s for s in sets if len(s)]
            rows = iter(_signatures(full, a, b)) if full else iter(())
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(ids, "Int64"),
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "signature": [next(rows).tobytes() if len(s) else None for s in sets],
                }
            )

    return only(documents, id_col, text_col).mapInPandas(run, "doc_id long, n_shingles long, digest binary, signature binary")


def _sets_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles of the documents that are nodes. documents has doc_id and text."""

    def run(frames):
        shingles = Shingler()
        for ids, texts in _chunks(frames):
            yield pd.DataFrame({"node": pd.array(ids, "Int64"), "shingles": [shingles(t).view(np.int64) for t in texts]})

    wanted = documents.join(small(nodes), documents["doc_id"] == F.col("node"), "left_semi")
    return wanted.mapInPandas(run, "node long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets share at least PERCENT of their union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), F.size(F.array_intersect("set_a", "set_b")).alias("shared"))
    return both.where(F.expr(f"100L * shared >= {PERCENT}L * (n_a + n_b - shared)")).select("a", "b").distinct()


def _like_sized(x: str, y: str) -> F.Column:
    """Sets of sizes further apart cannot share PERCENT of their union."""
    return F.expr(f"100L * least({x}, {y}) >= {PERCENT}L * greatest({x}, {y})")


def _neighbours(rows: DataFrame, region: list[str], reach: int, keep: list[str]) -> DataFrame:
    """(a, b) and the named columns of both, of rows at most reach places apart in their region's order."""
    place = Window.partitionBy(*region).orderBy("key", "node")
    back = F.array(*[F.struct(*[F.lag(c, k).over(place).alias(c) for c in keep]) for k in range(1, reach + 1)])
    near = rows.withColumn("back", back).select(*keep, F.explode("back").alias("o")).where("o.node IS NOT NULL")
    swap = F.col("node") > F.col("o.node")
    cols = [F.when(swap, F.col(f"o.{c}")).otherwise(F.col(c)).alias(f"{c}_a") for c in keep]
    cols += [F.when(swap, F.col(c)).otherwise(F.col(f"o.{c}")).alias(f"{c}_b") for c in keep]
    return near.where("node <> o.node").select(*cols)


def _links_of(blocks: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], signatures: np.ndarray, across: bool) -> list[tuple[int, int]]:
    """Pairs of rows whose sets share at least PERCENT of their union, as many as unite what can be
    united: rows of one part are united before. across: only pairs of different blocks."""
    size = np.array([len(s) for s in sets])
    i, j = np.triu_indices(len(sets), 1)
    wanted = (parts[i] != parts[j]) & (100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j]))
    if across:
        wanted &= blocks[i] != blocks[j]
    i, j = i[wanted], j[wanted]
    agree = np.concatenate([(signatures[i[k : k + 20_000]] == signatures[j[k : k + 20_000]]).sum(axis=1) for k in range(0, len(i), 20_000)] or [np.empty(0, np.int64)])
    order = np.argsort(-agree, kind="stable")[: int((agree >= AGREE).sum())]

    def linked(x: int, y: int) -> bool:
        shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return 100 * shared >= PERCENT * (int(size[x] + size[y]) - shared)

    return united(parts, ((x, y, lambda x=x, y=y: linked(x, y)) for x, y in zip(i[order].tolist(), j[order].tolist())))


def _verified(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) within each pair of blocks, from rows sorted by it."""
    for group in whole_groups(frames, ["cell", "low", "high"]):
        sets = [np.asarray(s, dtype=np.int64) for s in group["shingles"]]
        signatures = np.frombuffer(b"".join(group["signature"]), dtype=np.uint16).reshape(len(sets), -1)
        node = group["node"].to_numpy()
        found = _links_of(group["block"].to_numpy(), group["component"].to_numpy(), sets, signatures, group["low"].iloc[0] != group["high"].iloc[0])
        if found:
            x, y = np.array(found).T
            yield pd.DataFrame({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])})


def _mixed(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows (tree, prefix, key, node, component) of regions that hold several components, with their
    number of members n."""
    rows = shared.select("tree", "prefix", "key", "node").join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = rows.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("_least"), F.max("component").alias("_most"))
    return rows.join(sizes.where("_least < _most").drop("_least", "_most"), ["tree", "prefix"])


def _deepened(mixed: DataFrame) -> DataFrame:
    """cell, node, component: each region as it is where it has no more than CROWD rows, else its parts
    of the least depth at which they have no more. What shares the whole key in a crowd has no cell."""
    cell = lambda d: F.xxhash64("tree", F.substring("key", 1, d * _HASH_BYTES))
    own = ["node", "component"]
    cells = mixed.where(F.col("n") <= CROWD).select(cell(BASE).alias("cell"), *own)
    left = stored(mixed.where(F.col("n") > CROWD).drop("n"), "crowds")
    for depth in range(BASE + 1, DEPTH + 1):
        if not left.limit(1).count():
            break
        rows = left.withColumn("cell", cell(depth))
        rows = stored(rows.join(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cell"), f"depth-{depth}")
        cells = cells.unionByName(rows.where(F.col("n").between(2, CROWD)).select("cell", *own))
        left = rows.where(F.col("n") > CROWD).drop("cell", "n")
    return cells


def _rarest(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """cell, node, component of the crowd's nodes under each of their rarest shingles. Of a set in the
    order (times seen in the crowd, shingle), the first n - ceil(PERCENT n / 100) + 1 are enough: two
    sets that share PERCENT of their union have one of these in common."""
    own = sets.join(crowd, "node").select("node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("cell"))
    often = own.groupBy("cell").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    of = Window.partitionBy("node")
    # shingles seen once come first and lead to nobody
    rows = own.join(often, "cell").withColumns({"place": F.row_number().over(of.orderBy("often", "cell")), "seen": F.count(F.lit(1)).over(of)})
    return rows.where(F.expr(f"place <= seen - ceil({PERCENT} * n / 100) + 1")).select("cell", "node", "component")


def _links_in(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components among the nodes of each cell."""
    by = ["cell", "low", "high"]
    rows = in_blocks(cells, ["cell"]).join(sets, "node")
    return rows.repartition(*by).sortWithinPartitions(*by).mapInPandas(_verified, "a long, b long").distinct()


def _across(shared: DataFrame, placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components among the nodes of each region, deeper where it is crowded."""
    return _links_in(_deepened(stored(_mixed(shared, placed), "mixed-regions")), sets)


def _across_crowds(shared: DataFrame, placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components among all nodes of crowded regions, whatever depth they share."""
    crowd = stored(_mixed(shared, placed).where(F.col("n") > CROWD).select("node", "component").distinct(), "crowd")
    return _links_in(_rarest(crowd, sets), sets)


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    component_id is the least doc_id that links reach, a document's own where there are none. A
    text without words has no shingles and no links; a text of fewer than five words has one
    shingle. Rows that share an identifier are one document: linked with all that either is linked
    with. A null identifier is linked with nothing and kept, under a null component_id. An empty
    table gives an empty result; other columns are ignored.
    """
    source = only(documents, id_col, text_col)
    sketched = stored(sketches(source), "sketches")
    named = sketched.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = stored(named.groupBy("digest").agg(F.min("doc_id").alias("node")), "set-classes")
    leaf = named.join(classes.withColumnRenamed("digest", "own"), (named["doc_id"] == F.col("node")) & (named["digest"] == F.col("own")))
    leaf = leaf.select("node", F.col("n_shingles").alias("n"), "signature").dropDuplicates(["node", "signature"])

    width = DEPTH * _HASH_BYTES
    keys = F.array(*[F.substring("signature", 1 + t * width, width) for t in range(TREES)])
    trees = leaf.select("node", "n", F.posexplode(keys).alias("tree", "key")).withColumn("prefix", F.xxhash64(F.substring("key", 1, BASE * _HASH_BYTES)))
    regions = trees.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = trees.join(regions, ["tree", "prefix"])
    # a crowded region is sorted in several parts, which the second round brings together
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / SORTED_ROWS))
    shared = stored(shared.withColumn("part", part.cast("int")).drop("members"), "forest")
    sets = _sets_of(source, shared.select("node").distinct())
    sets = stored(sets.join(leaf.select("node", "signature"), "node"), "shingle-sets")

    # first round: each node's candidate that most orders put beside it
    near = _neighbours(shared, ["tree", "prefix", "part"], NEIGHBOURS, ["node", "n"]).where(_like_sized("n_a", "n_b"))
    near = near.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.count(F.lit(1)).alias("orders"))
    near = stored(near, "neighbours")
    ends = near.select("a", "b", "orders", F.explode(F.array("a", "b")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.desc("orders"), F.xxhash64("a", "b"))
    first = stored(ends.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("a", "b").distinct(), "first-pairs")
    links = stored(_confirmed(first, sets), "first-links")
    placed = stored(components(links), "first-components")

    # second round: what regions hold across components, then what crowds lost by going deeper
    for across, name in ((_across, "second"), (_across_crowds, "crowd")):
        more = stored(across(shared, placed, sets), f"{name}-links")
        if more.limit(1).count():
            links = links.unionByName(more)
            placed = stored(components(links), f"{name}-components")

    settled = classes.join(placed, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return (
        sketched.join(settled, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents, all columns, with one document of each group of near duplicates. Rows of null
    identifiers, and rows that share one but not the text, are documents of their own."""
    rows = row_keys(carried(documents, id_col, text_col))
    judged = near_duplicates(rows, "key", "text").withColumnRenamed("doc_id", "key")
    return without_rejected(rows, judged, ["key"], one=True)
