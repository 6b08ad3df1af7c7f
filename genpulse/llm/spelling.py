"""Spelling variants: words one edit apart, found by Aho-Corasick automata of their halves.

An edit leaves one half of a word as it is: where words v and w differ by one inserted, deleted or
replaced character, w begins with the first half of v or ends with its second half. So the words
are dealt to shards; the automaton of a shard holds both halves of each of its words, and all words
are scanned by each automaton. A hit counts where the half stands at its end of the scanned word
and the lengths fit; what is left of both words must then be one edit apart.

A half that many words share would make a hit compare them all. So the rests of such a half are
kept by what one deletion makes of them: two rests one edit apart have one of these in common, and
a hit looks up a few of them, however many words share the half.

The automaton of a shard is built from its rows as they stream in, before the words to be scanned;
a task has one shard and one slice of the words at a time. Nothing is collected on the driver, and
each word leaves a task as one row, with the number of words near it there and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, stored

#: Words of an automaton; words that one task scans with it.
SHARD_WORDS, SLICE_WORDS = 100_000, 100_000
#: Words that share a half from which on their rests are looked up instead of compared one by one.
CROWD = 12
#: Different words that a task counts before it hands them on.
COUNTED = 500_000
#: Shortest word, least number of occurrences, and how many times as common a word's form must be.
SHORTEST, OCCURRENCES, TIMES = 6, 5, 5

_RUN = "[A-Za-zÀ-ÿ]"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(text: str, shortest: int = 1) -> Iterator[tuple[str, int]]:
    """The maximal runs of letters of text of at least `shortest`, A to Z in lower case, with their
    number; a run that is written in several cases comes once for each."""
    for run, n in Counter(re.findall(f"{_RUN}{{{shortest},}}", text)).items():
        yield (run.lower() if run.isascii() else run.translate(_LOWER)), n


def word_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, one_in: int | None = None) -> DataFrame:
    """word, n of the runs of letters of all texts. one_in: where the checksum of identifier and run
    falls on one in so many, the run loses a character first. Counted in each task, then by word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: Counter = Counter()
        for frame in frames:
            for i, t in zip(frame["doc_id"], frame["text"]):
                begun = zlib.crc32(f"{'' if pd.isna(i) else int(i)}:".encode())
                for word, n in runs_of(t or "", shortest):
                    if one_in and (h := zlib.crc32(word.encode(), begun)) % one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    counted[word] += n
                if len(counted) >= COUNTED:
                    yield pd.DataFrame({"word": list(counted), "n": list(counted.values())})
                    counted = Counter()
        if counted:
            yield pd.DataFrame({"word": list(counted), "n": list(counted.values())})

    return only(documents, id_col, text_col).mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def shortened(text: str) -> set[str]:
    """text, and text less any one character."""
    return {text} | {text[:k] + text[k + 1 :] for k in range(len(text))}


def one_edit(v: str, w: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character leads from v to w."""
    if len(v) > len(w):
        v, w = w, v
    if len(w) - len(v) > 1 or v == w:
        return False
    k = 0
    while k < len(v) and v[k] == w[k]:
        k += 1
    return v[k + 1 :] == w[k + 1 :] if len(v) == len(w) else v[k:] == w[k + 1 :]


class Shard:
    """An automaton of the halves of words, each with the (rest, word, n) of the words that have it."""

    def __init__(self):
        self.first: dict[str, list] = {}
        self.second: dict[str, list] = {}
        self.shortened: dict[int, dict[str, list[int]]] = {}
        self.automaton = None

    def add(self, word: str, n: int) -> None:
        half = len(word) // 2
        a, b = word[:half], word[half:]
        self.first.setdefault(a, []).append((b, word, n))
        self.second.setdefault(b, []).append((a, word, n))

    def build(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for half in self.first.keys() | self.second.keys():
            self.automaton.add_word(half, (len(half), self.first.get(half), self.second.get(half)))
        self.automaton.make_automaton()

    def _one_edit_off(self, having: list, rest: str) -> list[tuple[str, int]]:
        """(word, n) of the words that have a half in common and a rest one edit from this one."""
        if len(having) <= CROWD:
            return [(w, n) for r, w, n in having if abs(len(r) - len(rest)) <= 1 and one_edit(r, rest)]
        lookup = self.shortened.get(id(having))
        if lookup is None:
            lookup = self.shortened[id(having)] = {}
            for k, (r, _, _) in enumerate(having):
                for s in shortened(r):
                    lookup.setdefault(s, []).append(k)
        places = {k for s in shortened(rest) for k in lookup.get(s, ())}
        return [having[k][1:] for k in places if one_edit(having[k][0], rest)]

    def near(self, word: str) -> dict[str, int]:
        """Words of the shard that are one edit from word, with their counts."""
        out: dict[str, int] = {}
        if not len(self.automaton):
            return out
        last = len(word) - 1
        for end, (size, first, second) in self.automaton.iter(word):
            if first is not None and end + 1 == size:
                out.update(self._one_edit_off(first, word[size:]))
            if second is not None and end == last:
                out.update(self._one_edit_off(second, word[: len(word) - size]))
        return out


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """word, n_near, form_n, form of scanned words, from rows (shard, slice, scanned, word, n) sorted by the first three."""
    at, shard = None, Shard()
    for frame in frames:
        out = []
        for s, k, scanned, word, n in zip(frame["shard"], frame["slice"], frame["scanned"], frame["word"], frame["n"]):
            if (s, k) != at:
                at, shard = (s, k), Shard()
            if not scanned:
                shard.add(word, n)
                continue
            if shard.automaton is None:
                shard.build()
            near = shard.near(word)
            if near:
                least, form = min((-m, w) for w, m in near.items())
                out.append((word, len(near), -least, form))
        if out:
            yield pd.DataFrame({c: [r[k] for r in out] for k, c in enumerate(("word", "n_near", "form_n", "form"))})


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, n_near, form, form_n of the words (word, n; each once) that have others one edit away:
    how many, and the commonest of them; of equally common ones the first in code-point order."""
    total = words.count()
    shards, slices = -(-total // shard_words) or 1, -(-total // slice_words) or 1
    dealt = lambda seed, parts: F.pmod(F.xxhash64("word", F.lit(seed)), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = words.select(dealt(1, shards).alias("shard"), each(slices).alias("slice"), F.lit(False).alias("scanned"), "word", "n")
    asked = words.select(each(shards).alias("shard"), dealt(2, slices).alias("slice"), F.lit(True).alias("scanned"), "word", "n")
    rows = held.unionByName(asked).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "scanned")
    found = rows.mapInPandas(_scan, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where following word to form, form to its form and so on ends, for the words of
    forms (word, form). Each round doubles the steps; a form is several times as common as its word,
    so chains have a logarithmic length and few rounds settle them."""
    hops = stored(forms.select("word", F.col("form").alias("root")), "form-hops")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = stored(hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "form-hops")
        if not hops.where("moved").limit(1).count():
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def spelling_variants(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    one_in: int | None = None,
    shortest: int = SHORTEST,
    occurrences: int = OCCURRENCES,
    times: int = TIMES,
    shard_words: int = SHARD_WORDS,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """One row per word of at least `shortest` characters and `occurrences` occurrences: word, n,
    n_near (words one edit away), form (the commonest of these if it is `times` as common; of
    equals the first in code-point order; else null), form_n and root (where forms lead to).

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A to Z in lower case. A null or
    empty text has none; a null identifier counts as an empty string where `one_in` misspells
    words. Repeated rows count each. No word gives an empty result; other columns are ignored.
    """
    counts = word_counts(documents, id_col, text_col, shortest, one_in)
    words = stored(counts.where(F.col("n") >= occurrences), "words")
    near = near_words(words, shard_words, slice_words)
    common = F.col("form_n") >= times * F.col("n")
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, F.col("form")).alias("form"), F.when(common, F.col("form_n")).alias("form_n"))
    joined = stored(joined, "word-forms")
    ends = roots(joined.where("form IS NOT NULL"))
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
