import random
import zlib
from collections import Counter
from itertools import product

import pandas as pd
import pytest
from helpers import same_as_duckdb

from genpulse.llm import queries
from genpulse.llm import spelling as sp


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = {v: m for v, m in counts.items() if sp.one_edit(v, w)}
        form = min(near, key=lambda v: (-near[v], v), default=None)
        form = form if form is not None and near[form] >= 5 * n else None
        out[w] = [form, None, n, len(near), near.get(form)]
    for w in out:
        end = w
        while out[end][0] is not None:
            end = out[end][0]
        out[w][1] = end
    return {w: tuple(x) for w, x in out.items()}


def table(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_one_edit_against_its_meaning():
    letters = "abé"
    words = ["".join(p) for n in range(5) for p in product(letters, repeat=n)]

    def reached(v):
        yield from (v[:k] + v[k + 1 :] for k in range(len(v)))
        yield from (v[:k] + c + v[k:] for k in range(len(v) + 1) for c in letters)
        yield from (v[:k] + c + v[k + 1 :] for k in range(len(v)) for c in letters if c != v[k])

    for v in words:
        want = set(reached(v))
        assert all(sp.one_edit(v, w) == (w in want) for w in words)


def test_variants_against_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    counts = {}
    for w in base:
        for _ in range(8):
            k, c = rng.randrange(len(w)), rng.choice("abcdéà")
            v = rng.choice([w, w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            if len(v) >= 6:
                counts[v] = rng.choice([5, 6, 30, 31, 150, 150, 4000])
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(counts)
    assert any(x[1] not in (w, x[0]) for w, x in want.items())  # some chains are longer than one step
    assert table(sp.spelling_variants(docs, shard_words=40, slice_words=90)) == want
    assert table(sp.spelling_variants(docs)) == want


def test_a_frame_without_scanned_words_gives_nothing():
    frame = pd.DataFrame({"shard": [0, 0], "slice": [0, 0], "scanned": [False, False], "word": ["abcdef", "ghijkl"], "n": [5, 6]})
    asked = pd.DataFrame({"shard": [0, 0], "slice": [0, 0], "scanned": [True, True], "word": ["abcdeg", "zzzzzz"], "n": [5, 5]})
    assert [r.tolist() for f in sp._scan(iter([frame, asked])) for r in f.to_numpy()] == [["abcdeg", 1, 5, "abcdef"]]


@pytest.mark.parametrize("crowd", [0, 3, 10**9])
def test_words_that_share_halves_are_looked_up(monkeypatch, crowd):
    monkeypatch.setattr(sp, "CROWD", crowd)
    shard = sp.Shard()
    words = ["prefix" + "".join(p) for p in product("abcdef", repeat=4)]
    for w in words:
        shard.add(w, 1)
    shard.build()
    for asked in ("prefixabcd", "prefixabc", "prefxabcd", "prefixabcde", "abcd"):
        assert set(shard.near(asked)) == {w for w in words if sp.one_edit(w, asked)}


def test_misspelt_words_and_odd_rows(spark, docs, empty):
    want = Counter()
    for r in docs.collect():
        for run, n in sp.runs_of(r.text or ""):
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run
            if len(run) >= 6:
                want[run] += n
    assert {r.word: r.n for r in sp.word_counts(docs, one_in=3).collect()} == dict(want)
    assert table(sp.spelling_variants(docs, one_in=3)) == brute({w: n for w, n in want.items() if n >= 5})
    assert sp.spelling_variants(empty).count() == 0
    rows = spark.createDataFrame([(None, "ÀÉîöüß ABCDEF abcdef"), (1, None), (1, "")] * 2, "doc_id long, text string")
    assert {r.word: r.n for r in sp.word_counts(rows).collect()} == {"ÀÉîöüß": 2, "abcdef": 4}


def test_letters_outside_ascii_keep_their_case():
    assert list(sp.runs_of("ÀB×c Àb×C ÀB×c ab")) == [("Àb×c", 2), ("Àb×c", 1), ("ab", 1)]
    assert list(sp.runs_of("abcde ABCDEF1abcdefg", 6)) == [("abcdef", 1), ("abcdefg", 1)]


def test_query_matches_its_sql(spark):
    same_as_duckdb(spark, "/root/testdata/sf0.001", queries.QUERIES["op12_aho_corasick_halves"], queries.ORACLES["op12_aho_corasick_halves"])
