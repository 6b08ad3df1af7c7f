"""Removal of byte strings that occur earlier in the corpus, by suffix arrays of shards.

Every string of LENGTH bytes has a key: the least hash of the GRAM-byte strings inside it. Equal
strings have equal keys, and strings that start in a row mostly share one, so a document is a few
runs of starts per hundred bytes, each a row with its key, its place and a hash of the bytes it
spans. The rows are sorted once by key and span. Keys that occur once cannot repeat anything. Of
runs that span the same bytes, all but the earliest are repeats. What is left, runs that share a key
and differ somewhere, can only share a string that also has the SIDE bytes before or behind the
key's place in common, so runs and halves of runs without a partner in that go. The others go to
shards by key: within a shard, the spanned bytes are put in suffix order by
induced sorting, permuted common prefixes show which starts have LENGTH bytes in common, and all
but the earliest of those are repeats. A key with very many different runs is divided over several
shards by the strings' own hashes. Of equal strings, a task sends the first on with its bytes and
the others as mere places, and a shard drops the rest as they stream in sorted, so neither a shard's
size nor what is held grows with the number of places where one string occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, row_keys, small, stored
from .induced_sort import common_prefixes, suffix_order

#: Bytes of a string that must not repeat, and of the strings whose least hash is its key.
LENGTH, GRAM = 100, 32
#: Bytes before or behind a key's place of which every string has one or the other.
SIDE = (LENGTH - GRAM) // 2
#: Different runs of a key before it is divided; bytes sorted at once.
CROWD, SHARD_BYTES = 4000, 800_000
#: Strings that a task remembers to have sent on.
SENT = 30_000
#: Different runs of one key that are held at once; bytes hashed at once.
HELD, BLOCK_BYTES = 200_000, 128_000
_BATCH_BYTES = 1_000_000
#: Bits of a run's number of starts in its place.
_COUNT_BITS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, size=256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _block_powers(base: np.uint64) -> np.ndarray:
    return _powers(base, 2 * BLOCK_BYTES)


def _first_powers(base: np.uint64, n: int) -> np.ndarray:
    return _block_powers(base)[:n] if n <= 2 * BLOCK_BYTES else _powers(base, n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of any stretch of some bytes, from running sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[data] * _first_powers(_BASE, len(data)), out=self.sums[1:])
        self.shift = _first_powers(_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.shift[start] + end.astype(np.uint64) - start.astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        return _mixed((self.sums[n:] - self.sums[:-n]) * self.shift[: len(self.sums) - n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, key, first start in it, number of starts, those of them with SIDE bytes before the
    key's place, hash of the bytes spanned, hashes of both sides) of the runs of documents of LENGTH
    bytes at least, which end at `ends` of data. The strings of a run take their key from the same
    place, so no two of them are equal."""
    n = len(data) - LENGTH + 1
    begins = np.append(0, ends[:-1])
    hashes = Hashes(data)
    grams = hashes.grams(GRAM)
    # half a hash and a place in one number; of equal halves the first is taken, in every document alike
    low = np.uint64(0xFFFFFFFF)
    at = (_least(grams & ~low | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1) & low).astype(np.int64)
    cut = np.append(True, at[1:] != at[:-1])
    cut[begins] = True
    beyond = ends - LENGTH + 1
    cut[beyond[:-1]] = True
    first = np.flatnonzero(cut)
    count = np.diff(np.append(first, n))
    doc = np.searchsorted(begins, first, side="right") - 1
    inside = first < beyond[doc]
    first, count, doc = first[inside], count[inside], doc[inside]
    at = at[first]
    before = np.clip(at - SIDE - first + 1, 0, count)
    left = np.where(before > 0, hashes.of(np.maximum(at - SIDE, 0), at + GRAM) >> np.uint64(32) | np.uint64(1), np.uint64(0))
    right = np.where(before < count, hashes.of(at, np.minimum(at + GRAM + SIDE, len(data))) >> np.uint64(32) | np.uint64(1), np.uint64(0))
    return doc, grams[at], first - begins[doc], count, before, hashes.of(first, first + count + LENGTH - 1), left << np.uint64(32) | right


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)


def _known(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The rows, less those that are there twice. One whose key and span an earlier place here also
    has is a repeat for sure: its place turns negative, and another key deals it anywhere."""
    both = rows["key"] ^ (rows["span"] << 1)
    order = np.argsort(both)
    same = both[order[1:]] == both[order[:-1]]
    order = order[np.append(same, False) | np.append(False, same)]
    if not len(order):
        return rows
    order = order[np.lexsort([rows[c][order] for c in ("place", "doc", "span", "key")])]
    key, span, doc, place = (rows[c][order] for c in ("key", "span", "doc", "place"))
    again = np.append(False, (key[1:] == key[:-1]) & (span[1:] == span[:-1]))
    twice = again & np.append(False, (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]))
    again, twice = order[again], order[twice]
    rows["key"][again] = _mixed((rows["doc"][again] ^ (rows["place"][again] << 20)).view(np.uint64)).view(np.int64)
    rows["place"][again] = ~rows["place"][again]
    stays = np.ones(len(both), bool)
    stays[twice] = False
    return {c: x[stays] for c, x in rows.items()}


def _all_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """key, span, doc, place, sides of the documents' runs. place: the start, how many starts have SIDE
    bytes before the key's place, and the number of starts; negative for a sure repeat."""
    parts: list[tuple[np.ndarray, ...]] = []
    docs: list[int] = []
    texts: list[bytes] = []
    size, held = 0, 0

    def hashed() -> None:
        nonlocal docs, texts, size
        if docs:
            doc, key, start, count, before, span, sides = runs(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(x) for x in texts]))
            place = (start << _COUNT_BITS | before) << _COUNT_BITS | count
            parts.append((key.view(np.int64), span.view(np.int64), np.array(docs, np.int64)[doc], place, sides.view(np.int64)))
            docs, texts, size = [], [], 0

    def joined() -> pd.DataFrame:
        names = ["key", "span", "doc", "place", "sides"]
        return pd.DataFrame(_known({c: np.concatenate([p[k] for p in parts]) for k, c in enumerate(names)}))

    for frame in frames:
        for doc, text in zip(frame["doc"].tolist(), frame["text"]):
            data = (text or "").encode("utf-8", "replace")
            if len(data) < LENGTH:
                continue
            docs.append(doc)
            texts.append(data)
            size += len(data)
            held += len(data)
            if size >= BLOCK_BYTES:
                hashed()
            if held >= _BATCH_BYTES:
                hashed()
                yield joined()
                parts, held = [], 0
    hashed()
    if parts:
        yield joined()


def _with_partners(key: np.ndarray, place: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, starts) of what of different runs, sorted by key, has the bytes of a side in common
    with another run of its key; first and last half of a run are told apart."""
    group = np.cumsum(np.append(False, key[1:] != key[:-1])).astype(np.uint64) << np.uint64(32)
    met = []
    for half in (sides.view(np.uint64) >> np.uint64(32), sides.view(np.uint64) & np.uint64(0xFFFFFFFF)):
        both = group | half
        order = np.argsort(both)
        same = both[order[1:]] == both[order[:-1]]
        alike = np.zeros(len(key), bool)
        alike[order] = np.append(same, False) | np.append(False, same)
        met.append(alike & (half != 0))
    mask = (1 << _COUNT_BITS) - 1
    start, before, count = place >> 2 * _COUNT_BITS, place >> _COUNT_BITS & mask, place & mask
    row = np.flatnonzero(met[0] | met[1])
    skipped = np.where(met[0], 0, before)
    return row, (start + skipped)[row], (np.where(met[1], count, before) - skipped)[row]


def _met(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc, start, starts, key, number, from all runs sorted by key, span, doc and place: the repeats of
    whole runs with number 0, and the k-th of different runs of a key that may share a string with number k.
    Holds one frame and the different runs of one key; of a key with over HELD, all go on."""
    names = ["key", "span", "doc", "place", "sides"]
    held = {c: np.empty(0, np.int64) for c in names}
    last: tuple | None = None
    passed_key, passed = 0, 0  # the key of which runs have gone on before it ended, and how many

    def out(doc: np.ndarray, start: np.ndarray, starts: np.ndarray, key: np.ndarray, number: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"doc": doc, "start": start.astype(np.int32), "starts": starts.astype(np.int32), "key": key, "number": number.astype(np.int32)})

    def whole(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
        return np.arange(len(rows["key"])), rows["place"] >> 2 * _COUNT_BITS, rows["place"] & (1 << _COUNT_BITS) - 1

    def more(rows: dict[str, np.ndarray]) -> pd.DataFrame:
        nonlocal passed_key, passed
        passed = passed if rows["key"][0] == passed_key else 0
        row, start, starts = whole(rows)
        frame = out(rows["doc"], start, starts, rows["key"], passed + 1 + row)
        passed_key, passed = rows["key"][0], passed + len(row)
        return frame

    def different(rows: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        if passed and rows["key"][0] == passed_key:
            n = int(np.searchsorted(rows["key"], passed_key, side="right"))
            yield more({c: x[:n] for c, x in rows.items()})
            rows = {c: x[n:] for c, x in rows.items()}
        if len(rows["key"]):
            row, start, starts = _with_partners(rows["key"], rows["place"], rows["sides"])
            key = rows["key"][row]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            number = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key)))) + 1
            yield out(rows["doc"][row], start, starts, key, number)

    for frame in frames:
        rows = {c: frame[c].to_numpy() for c in names}
        known = rows["place"] < 0
        if known.any():
            own = {c: x[known] for c, x in rows.items()} | {"place": ~rows["place"][known]}
            _, start, starts = whole(own)
            yield out(own["doc"], start, starts, own["key"], np.zeros(len(start), np.int32))
            rows = {c: x[~known] for c, x in rows.items()}
        if not len(rows["key"]):
            continue
        changes = {}
        for k, c in enumerate(names[:4]):
            changes[c] = np.append(last is None or last[k] != rows[c][0], rows[c][1:] != rows[c][:-1])
        last = tuple(rows[c][-1] for c in names[:4])
        new = changes["key"] | changes["span"]
        again = ~new & (changes["doc"] | changes["place"])
        if again.any():
            own = {c: x[again] for c, x in rows.items()}
            _, start, starts = whole(own)
            yield out(own["doc"], start, starts, own["key"], np.zeros(len(start), np.int32))
        held = {c: np.concatenate((held[c], rows[c][new])) for c in names}
        ready = int(np.searchsorted(held["key"], held["key"][-1])) if len(held["key"]) else 0
        if ready:
            yield from different({c: x[:ready] for c, x in held.items()})
            held = {c: x[ready:] for c, x in held.items()}
        if len(held["key"]) > HELD:
            yield more(held)
            held = {c: x[:0] for c, x in held.items()}
    if len(held["key"]):
        yield from different(held)


def _snippets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of wanted runs, whole, or start by start where their key is divided; a bounded part
    at a time. A start whose string this task has sent on from an earlier place is a repeat, and
    comes without its bytes."""
    rows, held = [], 0
    sent: dict[bytes, tuple[int, int]] = {}

    def done() -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["key", "shard", "doc", "start", "starts", "content"]).astype({"shard": "int64"})

    for frame in frames:
        for doc, text, *wanted in zip(*[frame[c] for c in ("doc", "text", "key", "start", "starts", "shards")]):
            raw = (text or "").encode("utf-8", "replace")
            for key, start, n, shards in zip(*[w.tolist() for w in wanted]):
                if start + n + LENGTH - 1 > len(raw):
                    continue
                if shards <= 1:
                    rows.append((key, 0, doc, start, n, raw[start : start + n + LENGTH - 1]))
                else:
                    for s in range(start, start + n):
                        piece = raw[s : s + LENGTH]
                        if piece in sent and sent[piece] < (doc, s):
                            before = rows[-1] if rows else None
                            if before and before[5] is None and before[2] == doc and before[3] + before[4] == s:
                                rows[-1] = (*before[:4], before[4] + 1, None)
                            else:
                                rows.append((key, s, doc, s, 1, None))
                            continue
                        if len(sent) >= SENT:
                            sent.clear()
                        sent[piece] = (doc, s)
                        shard = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little") % shards
                        rows.append((key, shard, doc, s, 1, piece))
                held += n + LENGTH
            if held >= _BATCH_BYTES:
                yield done()
                rows, held = [], 0
    if rows:
        yield done()


def repeats(doc: np.ndarray, start: np.ndarray, starts: np.ndarray, content: list[bytes]) -> tuple[np.ndarray, ...]:
    """(doc, start, starts) of the runs of starts whose LENGTH bytes also start earlier, among the
    runs given with the bytes they span."""
    sizes = np.array([len(c) for c in content])
    first = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"".join([c + b"\0" for c in content]), dtype=np.uint8).astype(np.int16) + 2
    text[first + sizes] = 1  # ends of runs, below all bytes
    offset = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    positions = np.repeat(first, starts) + offset
    run_at = np.full(len(text), -1, dtype=np.int64)
    run_at[positions] = np.repeat(np.arange(len(starts)), starts)
    order = suffix_order(text)
    order = order[run_at[order] >= 0]
    shared = common_prefixes(text, order, first, starts, LENGTH)
    group = np.flatnonzero(np.append(True, shared[1:] < LENGTH)) if len(order) else np.empty(0, np.int64)
    # the place of each start in the corpus, as one number
    place_of = np.empty(len(positions), dtype=np.int64)
    by_place = np.lexsort((np.repeat(start, starts) + offset, np.repeat(doc, starts)))
    docs, at = np.repeat(doc, starts)[by_place], (np.repeat(start, starts) + offset)[by_place]
    place_of[by_place] = np.cumsum(np.append(True, (docs[1:] != docs[:-1]) | (at[1:] != at[:-1])))
    place = np.zeros(len(text), dtype=np.int64)
    place[positions] = place_of
    sorted_place = place[order]
    earliest = np.repeat(np.minimum.reduceat(sorted_place, group), np.diff(np.append(group, len(order))))
    again = np.zeros(len(text), dtype=bool)
    again[order[sorted_place > earliest]] = True
    flags = again[positions]
    edge = flags & ~(np.append(False, flags[:-1]) & (offset > 0))
    at = np.flatnonzero(edge)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    total = np.cumsum(flags)
    number = np.append(total[at[1:] - 1], total[-1]) - total[at] + 1
    run = np.repeat(np.arange(len(starts)), starts)[at]
    return doc[run], start[run] + offset[at], number


def _sorted_shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeats in rows that come sorted by key, shard, content and place; batches end between keys.
    Rows without content are repeats, as are those whose key and content are those of the row before."""
    held: list[pd.DataFrame] = []
    size, before = 0, None

    def done(frame: pd.DataFrame) -> pd.DataFrame:
        d, s, n = repeats(frame["doc"].to_numpy(np.int64), frame["start"].to_numpy(np.int64), frame["starts"].to_numpy(np.int64), frame["content"].tolist())
        return pd.DataFrame({"doc": d, "start": s.astype(np.int32), "starts": n.astype(np.int32)})

    for frame in frames:
        known = frame["content"].isna().to_numpy()
        if known.any():
            yield frame.loc[known, ["doc", "start", "starts"]]
            frame = frame[~known]
        if not len(frame):
            continue
        content, by = frame["content"].to_numpy(), frame[["key", "shard"]].to_numpy()
        again = np.append(False, (content[1:] == content[:-1]) & (by[1:] == by[:-1]).all(axis=1))
        again[0] = before is not None and before == (*by[0], content[0])
        before = (*by[-1], content[-1])
        if again.any():
            yield frame.loc[again, ["doc", "start", "starts"]]
            frame = frame[~again]
        if not len(frame):
            continue
        held.append(frame)
        size += int(frame["content"].map(len).sum())
        if size >= SHARD_BYTES:
            whole = pd.concat(held, ignore_index=True)
            last = (whole["key"] != whole["key"].iloc[-1]) | (whole["shard"] != whole["shard"].iloc[-1])
            ready = int(np.flatnonzero(last.to_numpy())[-1]) + 1 if last.any() else 0
            if ready:
                yield done(whole.iloc[:ready])
            held = [whole.iloc[ready:]]
            size = int(held[0]["content"].map(len).sum())
    if held and size:
        yield done(pd.concat(held, ignore_index=True))


def repeated_starts(source: DataFrame) -> DataFrame:
    """(doc, start, starts): runs of starts in source (doc, text) whose LENGTH bytes start earlier too."""
    all_runs = source.mapInPandas(_all_runs, "key long, span long, doc long, place long, sides long")
    met = all_runs.repartition("key").sortWithinPartitions("key", "span", "doc", "place")
    shared = stored(met.mapInPandas(_met, "doc long, start int, starts int, key long, number int"), "repeated-runs")
    copies = shared.where("number = 0").select("doc", "start", "starts")
    different = shared.where("number > 0")
    crowds = different.where(F.col("number") > CROWD).groupBy("key").agg(F.ceil(F.max("number") / CROWD).cast("int").alias("shards"))
    different = different.join(F.broadcast(stored(crowds, "crowds")), "key", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    wanted = stored(different.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "starts", "shards")).alias("wanted")), "wanted-runs")
    texts = source.join(small(wanted.select("doc")), "doc", "left_semi")
    # arrays of numbers, not of structs, which Python would hold as dictionaries
    asked = texts.join(wanted, "doc").select("doc", "text", *[F.col(f"wanted.{c}").alias(c) for c in ("key", "start", "starts", "shards")])
    # in order, so that a task that runs again sends on the same places
    snippets = asked.sortWithinPartitions("doc").mapInPandas(_snippets, "key long, shard long, doc long, start int, starts int, content binary")
    dealt = snippets.repartition("key", "shard").sortWithinPartitions("key", "shard", "content", "doc", "start")
    sorted_out = dealt.mapInPandas(_sorted_shards, "doc long, start int, starts int")
    return copies.unionByName(sorted_out)


def _kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, held = [], 0

    def done() -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})

    for frame in frames:
        for doc, text, starts, counts in zip(frame["doc_id"], frame["text"], frame["start"], frame["starts"]):
            raw = (text or "").encode("utf-8", "replace")
            removed, n_spans, out, last = 0, 0, [], 0
            gone: list[list[int]] = []
            for s in sorted(zip(starts.tolist(), (starts + counts + LENGTH - 1).tolist())) if starts is not None else []:
                if gone and s[0] <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], s[1])
                else:
                    gone.append(list(s))
            for s, e in gone:
                out.append(raw[last:s])
                removed, n_spans, last = removed + e - s, n_spans + 1, e
            kept = b"".join([*out, raw[last:]])
            rows.append((None if pd.isna(doc) else int(doc), len(raw), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
            held += len(raw)
            if held >= _BATCH_BYTES:
                yield done()
                rows, held = [], 0
    if rows:
        yield done()


def substring_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with_kept, kept:
    the bytes that stay, which may cut a character.

    A byte goes if a string of LENGTH bytes covers it that also starts earlier: in a document of
    smaller doc_id, or before in the same. A null text is empty. Rows that share an identifier and
    the text are one document, each judged alike; where rows of one identifier differ in text, all
    texts but one come after all other identifiers. A null doc_id is a document of its own and
    comes last, in no stated order among its like; of those with the same text one stays. An empty
    table gives an empty result; other columns are ignored.
    """
    source = row_keys(only(documents, id_col, text_col)).withColumnRenamed("key", "doc")
    spans = stored(repeated_starts(source.select("doc", "text")), "repeated-starts")
    by_doc = stored(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "starts")).alias("spans")), "spans-by-document")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ids = small(by_doc.select("doc"))
    touched = source.join(ids, "doc", "left_semi").join(by_doc, "doc").select("doc_id", "text", "spans")
    kind = by_doc.schema["spans"].dataType
    whole = source.join(ids, "doc", "left_anti").select("doc_id", "text", F.lit(None).cast(kind).alias("spans"))
    # copies under null identifiers go whole, as all their strings start in the first of them
    copied = stored(source.where("doc_id IS NULL").groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "null-copies")
    if copied.limit(1).count():
        again = F.row_number().over(Window.partitionBy("doc").orderBy("doc")) > 1
        starts = F.octet_length("text") - LENGTH + 1
        everything = F.array(F.struct(F.lit(0).alias("start"), starts.alias("starts"))).cast(kind)
        copies = source.join(small(copied), "doc", "left_semi").join(by_doc, "doc", "left").withColumn("again", again & (starts > 0))
        copies = copies.select("doc_id", "text", F.when(F.col("again"), everything).otherwise(F.col("spans")).alias("spans"))
        single = source.join(small(copied), "doc", "left_anti")
        touched = single.join(ids, "doc", "left_semi").join(by_doc, "doc").select("doc_id", "text", "spans").unionByName(copies)
        whole = single.join(ids, "doc", "left_anti").select("doc_id", "text", F.lit(None).cast(kind).alias("spans"))
    marked = touched.unionByName(whole).select("doc_id", "text", *[F.col(f"spans.{c}").alias(c) for c in ("start", "starts")])
    out = marked.mapInPandas(_kept, schema)
    return out if with_kept else out.drop("kept")
