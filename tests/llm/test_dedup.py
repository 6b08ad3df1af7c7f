import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from genpulse.llm import common, exact_dedup, induced_sort, line_dedup, near_dedup, substring_dedup
from genpulse.llm.components import components


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def text_of(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_exact_groups(docs):
    got, texts, groups = by_id(exact_dedup.exact_groups(docs)), text_of(docs), defaultdict(list)
    for i, t in texts.items():
        groups[t].append(i)
    for i, t in texts.items():
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest())


def test_exact_groups_of_repeats_and_nulls(repeated, empty):
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(repeated).collect())
    assert rows == [(False, 1, 1, 3, False), (False, 1, 1, 3, True), (False, 2, 2, 2, True), (True, 0, 1, 3, False), (True, 0, 2, 2, False)]
    assert exact_dedup.exact_groups(empty).count() == 0
    assert {r.keep_id for r in exact_dedup.exact_groups(repeated, keep="min").collect()} == {1, 2}


def test_a_group_is_divided_and_whole(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    hot = exact_dedup.exact_groups(docs).where("group_size > 1")
    assert (hot.count(), hot.where("kept").count(), hot.first().keep_id) == (1000, 1, 2997)


def brute_components(sets, percent=75):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(docs):
    sets = {i: shingles(t) for i, t in text_of(docs).items()}
    truth, got = brute_components(sets), by_id(near_dedup.near_duplicates(docs))
    assert {i: (len(s), truth[i], truth[i] == i) for i, s in sets.items()} == {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()}


def test_near_duplicates_of_a_large_group(spark, words):
    base = (words * 2)[:300]
    rows = []
    for i in range(200):
        changed = list(base)
        changed[i] = f"edit{i}"
        rows.append((i, " ".join(changed)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}


def test_near_duplicates_of_repeats_and_nulls(repeated, empty):
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(repeated).where("n_shingles IS NOT NULL").collect())
    assert rows == [(False, 1, 1, 1, True), (False, 1, 1, 1, True), (False, 2, 0, 2, True), (True, 0, 0, None, True), (True, 0, 1, None, True)]
    assert near_dedup.near_duplicates(empty).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 200), (300, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(51)} | {100: 100, 200: 100, 300: 100}


@pytest.mark.parametrize("letters", [1, 2, 4, 60])
def test_suffix_order_and_common_prefixes(letters):
    rng = np.random.default_rng(letters)
    for _ in range(40):
        x = rng.integers(1, letters + 1, rng.integers(1, 120))
        order = induced_sort.suffix_order(x)
        assert order.tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())
        reach = 4
        if len(x) > reach:
            n = len(x) - reach + 1
            starts = order[order < n]
            shared = induced_sort.common_prefixes(x, starts, np.array([0]), np.array([n]), reach)
            for k in range(1, n):
                a, b = x[starts[k - 1] :][:reach].tolist(), x[starts[k] :][:reach].tolist()
                assert shared[k] == next((m for m in range(reach) if a[m] != b[m]), reach)


def brute_substrings(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(raw[p : p + 100])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), sum(1 for part in bytes(gone).split(b"\0") if part), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4000)
    got = by_id(substring_dedup.substring_dedup(docs))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute_substrings(text_of(docs))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.values())


def test_substring_dedup_with_divided_keys(spark, docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWD", 1)
    got = by_id(substring_dedup.substring_dedup(docs, with_kept=False))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute_substrings(text_of(docs))


def test_substring_dedup_of_one_string_in_many_contexts(spark, words, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWD", 50)
    shared = (" ".join(words[:40]) + " ")[:120]
    texts = {i: " ".join(words[(7 * i + k * k) % len(words)] + str(i) for k in range(12)) + shared + str(i) * 30 for i in range(1500)}
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(8)
    got = by_id(substring_dedup.substring_dedup(docs, with_kept=False))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == brute_substrings(texts)


def test_a_shard_does_not_hold_every_place_of_a_string(monkeypatch):
    """Equal strings stream by; strings that a task sent on before come without their bytes."""
    sorted_at_once, real = [], substring_dedup.repeats
    monkeypatch.setattr(substring_dedup, "repeats", lambda d, s, n, content: sorted_at_once.append(sum(map(len, content))) or real(d, s, n, content))
    texts = pd.DataFrame({"doc": range(20_000), "text": ["x" * (i % 7) + "boilerplate " * 10 for i in range(20_000)]})
    asked = texts.assign(key=[np.array([5])] * 20_000, start=[np.array([i % 7]) for i in range(20_000)], starts=[np.array([21])] * 20_000, shards=[np.array([3])] * 20_000)
    parts = [pd.concat(substring_dedup._snippets(iter([asked.iloc[k : k + 5000]]))) for k in range(0, 20_000, 5000)]
    sent = pd.concat(parts, ignore_index=True)
    assert sent["content"].notna().sum() == 4 * 12
    rows = sent.sort_values(["key", "shard", "content", "doc", "start"], ignore_index=True)
    found = pd.concat(substring_dedup._sorted_shards(rows.iloc[k : k + 1000] for k in range(0, len(rows), 1000)))
    assert sum(sorted_at_once) == 12 * 100 and found["starts"].sum() == 20_000 * 21 - 12


@pytest.mark.parametrize("held, size", [(1, 7), (3, 1), (200_000, 50), (200_000, 100_000)])
def test_only_runs_with_a_partner_go_to_shards(words, monkeypatch, held, size):
    """A phrase shorter than what a side needs brings no run to shards; every repeat is told at once or asked about."""
    monkeypatch.setattr(substring_dedup, "HELD", held)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 5_000)
    rng = np.random.default_rng(3)
    text = lambda n: " ".join(rng.choice(words, n)) + f" {rng.integers(1 << 60)} "
    phrase, passage = "a phrase of forty-eight characters that all have", text(60)
    texts = [text(20) + phrase + text(20) for _ in range(40)]
    texts += [text(15) + passage[k : k + 110 + 5 * k] + text(15) for k in range(30)] + [passage] * 3 + ["short", ""]
    frame = pd.DataFrame({"doc": range(len(texts)), "text": texts})
    rows = pd.concat([x for k in range(0, len(frame), 20) for x in substring_dedup._all_runs(iter([frame.iloc[k : k + 20]]))])
    rows = rows.sort_values(["key", "span", "doc", "place"], ignore_index=True)
    out = pd.concat(substring_dedup._met(rows.iloc[k : k + size] for k in range(0, len(rows), size)))
    starts = lambda rows: {(d, s + k) for d, s, n in zip(rows["doc"], rows["start"], rows["starts"]) for k in range(n)}
    first, repeats = {}, set()
    for d, x in enumerate(texts):
        for s in range(len(x) - 99):
            if first.setdefault(x[s : s + 100], (d, s)) != (d, s):
                repeats.add((d, s))
    sure, asked = starts(out[out["number"] == 0]), starts(out[out["number"] > 0])
    assert sure and sure <= repeats <= sure | asked
    assert all(first[texts[d][s : s + 100]] in asked for d, s in repeats - sure)
    assert all(sorted(g) == list(range(1, len(g) + 1)) for _, g in out[out["number"] > 0].groupby("key")["number"])
    assert held < 10 or all(d >= 40 for d, _ in asked)


def test_substring_dedup_of_repeats_and_nulls(repeated, empty):
    assert {(r.n_bytes, r.n_removed) for r in substring_dedup.substring_dedup(repeated).collect()} == {(9, 0), (0, 0)}
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_fuzzy_lines(spark, words):
    line = " ".join(words[:40])
    rows = [(1, f"{line}\nshort\n\n--"), (2, f"Short!\n{line}, again\n{' '.join(words[50:90])}"), (3, f"{line.upper()}\n{' '.join(words[100:140])}"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(line_dedup.line_dedup(docs))
    assert [(i, got[i].n_lines, got[i].n_removed, got[i].removed_lines) for i in (1, 2, 3, 4, 5)] == [(1, 2, 0, ""), (2, 3, 2, "0,1"), (3, 2, 1, "0"), (4, 0, 0, ""), (5, 0, 0, "")]
    left = {r.doc_id: r.text for r in line_dedup.without_duplicate_lines(docs).collect()}
    assert left == {1: rows[0][1], 2: " ".join(words[50:90]), 3: " ".join(words[100:140]), 4: None, 5: ""}


def plain(line):
    return re.sub(r"[\W_]+", " ", re.sub(r"\d+", "0", line.lower())).strip()


def test_equal_lines_are_always_found(docs):
    seen, want = set(), {}
    for i, t in sorted(text_of(docs).items()):
        norms = [plain(x) for x in t.split("\n")]
        want[i] = sum(n in seen or norms.index(n) < k for k, n in enumerate(norms) if n)
        seen.update(norms)
    got = by_id(line_dedup.line_dedup(docs))
    assert all(got[i].n_removed >= n for i, n in want.items())


def test_fuzzy_lines_of_repeats_and_nulls(repeated, empty):
    assert line_dedup.line_dedup(repeated).count() == 5
    assert line_dedup.line_dedup(empty).count() == 0


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


@pytest.mark.parametrize("n", [6, 10, 16, 30])
@pytest.mark.parametrize("kind", ["letter", "word"])
def test_fuzzy_lines_against_brute_force(spark, n, kind):
    rng = np.random.default_rng(n)
    word = lambda: "".join(rng.choice(list("abcdeghilmnorstu"), rng.integers(3, 9)))
    rows, want = [], 0
    for k in range(150):
        line = [word() for _ in range(n)]
        changed, at = list(line), rng.integers(n)
        changed[at] = word() if kind == "word" else "q" + changed[at][1:]
        x, y = " ".join(line), " ".join(changed)
        want += 100 * edits(x, y) <= 15 * max(len(x), len(y))
        rows += [(2 * k, x), (2 * k + 1, y)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0]
    assert 0.97 * want <= got <= want and want > 20


def test_a_crowded_cell_is_compared_in_full(spark):
    from genpulse.llm.components import in_blocks

    rows = spark.range(700).selectExpr("1L AS cell", "id AS node", "if(id < 400, 0L, id) AS component")
    met = in_blocks(rows, ["cell"])
    x, y = (met.selectExpr("cell", "low", "high", f"node AS {n}", f"component AS c{n}") for n in "xy")
    pairs = x.join(y, ["cell", "low", "high"]).where("x < y AND cx <> cy").select("x", "y").distinct()
    assert pairs.count() == 700 * 699 // 2 - 400 * 399 // 2


def test_lines_of_clean_texts_stay_under_shared_and_null_identifiers(spark):
    twice = "a line that stands in two documents"
    rows = [(1, twice), (2, f"{twice}\na tail"), (2, "a precious first line of another text\nx y z"), (None, "keep this clean line please"), (None, f"{twice}\nwhat a null document says itself"), (3, twice), (3, twice)]
    df = spark.createDataFrame([(i, t, "k", "r") for i, t in rows], "doc_id long, text string, key string, row string")
    got = line_dedup.without_duplicate_lines(df)
    assert got.columns == df.columns
    want = [(1, twice), (2, "a tail"), (2, "a precious first line of another text\nx y z"), (None, "keep this clean line please"), (None, "what a null document says itself"), (3, ""), (3, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))


def test_substring_dedup_of_long_texts_under_null_and_shared_identifiers(spark, words):
    rng = np.random.default_rng(3)
    prose = lambda: " ".join(rng.choice(words, 60))
    a, b, c, d, e, passage = (prose() for _ in range(6))
    rows = [(1, passage), (None, f"{a} {passage}"), (None, b), (None, c), (None, c), (7, d), (7, f"{passage} {e}")]
    got = {}
    for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.kept.decode()))
    assert got[1] == [(len(passage), 0, passage)]
    assert sorted(x[2] for x in got[None]) == sorted(["", a + " ", b, c]) or sorted(x[2] for x in got[None]) == sorted(["", a, b, c])
    assert sorted(x[2] for x in got[7]) == sorted([d, " " + e])
    assert all(0 <= gone <= n for x in got.values() for n, gone, _ in x)


def test_near_duplicates_of_a_template_crowd(spark, words):
    rng = np.random.default_rng(6)
    template = list(rng.choice(words, 240))
    texts = []
    for k in range(160):
        own = template + list(rng.choice(words, 60))
        texts += [" ".join(own), " ".join(own[:-24] + [f"v{k}x{j}" for j in range(40)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    truth = brute_components({i: shingles(t) for i, t in enumerate(texts)})
    assert {i: r.component_id for i, r in by_id(near_dedup.near_duplicates(docs)).items()} == truth


def test_a_region_of_equal_keys_is_compared_in_full(spark):
    from genpulse.llm.components import components

    rows = spark.range(600).selectExpr("0 AS tree", "1L AS prefix", "X'00' AS key", "id AS node", "100L AS n")
    placed = spark.range(500).selectExpr("id AS node", "0L AS component")
    signature = "cast(repeat('a', 320) AS binary) AS signature"
    sets = spark.range(600).selectExpr("id AS node", "sequence(1L, 100L) AS shingles", signature)
    united = components(near_dedup._across(rows, placed, sets).unionByName(spark.range(1, 500).selectExpr("0L AS a", "id AS b")))
    assert united.where("component = 0").count() == 600


@pytest.mark.parametrize("crowd", [8, 64])
def test_crowds_go_deeper_and_lose_no_link(spark, words, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    rng = np.random.default_rng(8)
    template = list(rng.choice(words, 240))
    texts = []
    for _ in range(120):
        own = template + list(rng.choice(words, 60))
        texts += [" ".join(own), " ".join(own[:-24] + [str(x) for x in rng.integers(0, 10**9, 40)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    truth = brute_components({i: shingles(t) for i, t in enumerate(texts)})
    assert {i: r.component_id for i, r in by_id(near_dedup.near_duplicates(docs)).items()} == truth


def test_rarest_shingles_bring_every_linked_pair_together(spark):
    rng = np.random.default_rng(9)
    bases = [set(map(int, rng.choice(400, 60, replace=False))) for _ in range(12)]
    sets = []
    for _ in range(150):
        s = set(bases[rng.integers(12)])
        s -= set(map(int, rng.choice(400, rng.integers(0, 80))))
        sets.append(s | set(map(int, rng.choice(400, rng.integers(1, 12)))))
    table = spark.createDataFrame([(i, [int(x) for x in s]) for i, s in enumerate(sets)], "node long, shingles array<long>")
    crowd = spark.range(150).selectExpr("id AS node", "id AS component")
    cells = {}
    for r in near_dedup._rarest(crowd, table).collect():
        cells.setdefault(r.cell, set()).add(r.node)
    linked = [(i, j) for i in range(150) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(linked) > 20
    assert all(any({i, j} <= c for c in cells.values()) for i, j in linked)


@pytest.mark.parametrize("n", [2_000, 8_000, 32_000])
def test_rows_of_a_united_crowd_grow_with_its_nodes(spark, n):
    from genpulse.llm.components import in_blocks

    rows = spark.range(n).selectExpr("1L AS cell", "id AS node", "if(id < 200, id, 200L) AS component")
    assert in_blocks(rows, ["cell"]).count() <= n + 200 * (n // 512 + 2)


def test_rows_of_a_crowd_without_links_grow_with_its_nodes(spark):
    # a template of 60 shingles and 40 own ones: nobody is linked, and rare shingles lead to nobody
    made = {}
    for n in (500, 2_000):
        sets = spark.range(n).selectExpr("id AS node", "concat(sequence(1L, 60L), sequence(1000 + 40 * id, 1039 + 40 * id)) AS shingles")
        made[n] = near_dedup._rarest(spark.range(n).selectExpr("id AS node", "id AS component"), sets).count()
    assert made[500] == made[2_000] == 0


def test_fuzzy_lines_of_any_length(spark, words):
    rng = np.random.default_rng(4)
    line = " ".join(rng.choice(words, 40_000))
    rows = [(1, line), (2, line[:100_000] + "zq" + line[100_002:]), (3, "a line of its own")]
    assert [r.n_removed for r in sorted(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())] == [0, 1, 0]


@pytest.mark.parametrize("n", [16, 30, 60])
def test_letter_edits_in_lines_over_any_length_have_keys(spark, n):
    # one letter of every fourth word: few words stand, so what is found in long lines comes from trigrams too
    rng = np.random.default_rng(n)
    word = lambda: "".join(rng.choice(list("abcdeghilmnorstu"), rng.integers(5, 9)))
    rows = []
    for k in range(100):
        line = [word() for _ in range(n)]
        changed = ["q" + w[1:] if i % 4 == 0 else w for i, w in enumerate(line)]
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(changed))]
    assert 90 <= line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0] <= 100


def test_every_pair_one_edit_apart_is_found_where_one_is_allowed(spark):
    rng = np.random.default_rng(12)
    letters = list("abcdefghij")
    rows, want = [], 0
    for k in range(200):
        x = "".join(rng.choice(letters, rng.integers(8, 13)))
        at, kind = rng.integers(len(x)), k % 3
        y = x[:at] + ("" if kind == 0 else "z" if kind == 1 else "z" + x[at]) + x[at + 1 :]
        want += 100 * edits(x, y) <= 15 * max(len(x), len(y))
        rows += [(2 * k, x), (2 * k + 1, y)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0]
    assert got == want == 200


def test_bounds_refuse_no_similar_lines(monkeypatch):
    rng = np.random.default_rng(13)
    syllables = ["er", "an", "th", "ion", "ea", "re", "on", " "]
    lines = []
    for _ in range(40):
        x = "".join(rng.choice(syllables, rng.integers(20, 400))).strip()
        y = list(x)
        for at in rng.integers(0, len(y), int(len(y) * rng.uniform(0, 0.25))):
            y[at] = rng.choice(list("abc"))
        lines += [x, "".join(y)]
    own = np.arange(len(lines))
    similar = {(i, j) for i in own for j in own[i + 1 :] if 100 * line_dedup.edits(lines[i], lines[j]) <= 15 * max(len(lines[i]), len(lines[j]))}
    assert 10 < len(similar) < 60
    # each test on its own, so none is skipped for what others have united
    monkeypatch.setattr(line_dedup, "united", lambda parts, pairs: [(x, y) for x, y, linked in pairs if linked()])
    assert set(line_dedup._alike(own * 0, own, lines, False)) == similar


def test_edits_up_to_a_bound():
    rng = np.random.default_rng(14)
    for _ in range(300):
        x, y = ("".join(rng.choice(list("abc"), rng.integers(0, 40))) for _ in range(2))
        true, most = edits(x, y), int(rng.integers(0, 20))
        assert line_dedup.edits(x, y) == true
        assert (line_dedup.edits(x, y, most) <= most) == (true <= most)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "αβγδ漢字", "\U0001f600x y"])
def test_edits_of_many_pairs_at_once(monkeypatch, letters):
    monkeypatch.setattr(line_dedup, "BATCHED", 350)
    rng = np.random.default_rng(15)
    lines = []
    for _ in range(60):
        x = list(rng.choice(list(letters), rng.integers(1, 400)))
        y = list(x)
        for _ in range(rng.integers(0, len(x) // 3 + 1)):
            at = rng.integers(0, len(y))
            y[at : at + rng.integers(0, 2)] = rng.choice(list(letters), rng.integers(0, 2)) if len(y) > 1 else y
        lines += ["".join(x), "".join(y)]
    i = np.concatenate((np.arange(0, 120, 2), rng.integers(0, 120, 100)))
    j = np.concatenate((np.arange(1, 120, 2), rng.integers(0, 120, 100)))
    true = np.array([edits(lines[a], lines[b]) for a, b in zip(i, j)])
    for most in (true, true - 1, true + 1, true * 0 + 30):
        assert (line_dedup._within(lines, i, j, most) == (true <= most)).all()
        assert not (line_dedup._plain(lines, i, j, most) & (true > most)).any()


def test_keys_in_parts_are_all_that_several_rows_have(monkeypatch):
    monkeypatch.setattr(line_dedup, "KEY_ROWS", 100)
    rng = np.random.default_rng(16)
    cells = rng.integers(-(1 << 63), 1 << 63, size=400)[rng.integers(400, size=1_000)] >> 9 << 9 | rng.integers(1 << 9, size=1_000)
    rows = pd.DataFrame({"cell": cells, "node": rng.integers(50, size=1_000)})
    monkeypatch.setattr(line_dedup, "_cells", lambda frames: frames)
    dealt = pd.concat(line_dedup._dealt((rows[k : k + 70] for k in range(0, 1_000, 70)), 12)).sort_values("part")
    assert dealt["part"].between(0, 11).all() and dealt["part"].nunique() == 12
    got = pd.concat(line_dedup._in_order(dealt[k : k + 9] for k in range(0, len(dealt), 9)))
    several = rows[rows.groupby(rows["cell"] // 512)["cell"].transform("size") > 1]
    assert sorted(got.values.tolist()) == sorted(several.values.tolist())
    key = got["cell"] // 512
    assert (key != key.shift()).sum() == key.nunique()


def test_a_crowd_of_many_lengths_meets_by_length(spark):
    rng = np.random.default_rng(17)
    size = np.exp(rng.uniform(np.log(60), np.log(2_000), 3_000)).astype(int)
    kind = line_dedup._packed(np.zeros(3_000, np.int64), size, False) >> 1
    rows = spark.createDataFrame(pd.DataFrame({"cell": [1] * 2_980 + [2] * 10 + [3] * 10, "early": [True] * 2_980 + [False] * 10 + [True] * 10, "node": range(3_000), "kind": kind.astype(np.int32), "component": range(3_000)}))
    got = line_dedup._by_length(rows).toPandas()
    windows = got.groupby("node")["window"].agg(set)
    for a, b in rng.integers(2_980, size=(20_000, 2)):
        assert 100 * min(size[a], size[b]) < 85 * max(size[a], size[b]) or windows[a] & windows[b]
    # a cell of one block has met in the first round, if that took it
    assert len(got[got["cell"] == 2]) == 10 and not (got["cell"] == 3).any()
    from genpulse.llm.components import in_blocks

    assert 2 * in_blocks(line_dedup._by_length(rows), ["cell", "window"]).count() < in_blocks(rows.drop("kind", "early"), ["cell"]).count()


def test_fuzzy_lines_take_little_disk(spark, words, tmp_path, monkeypatch):
    # lines of one vocabulary without partners: neither their keys nor their texts are stored again and again
    rng = random.Random(31)
    rows = [(k, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(20, 60))) for _ in range(8))) for k in range(250)]
    monkeypatch.setattr(common, "scratch_root", lambda _: f"file://{tmp_path}")
    assert line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0] == 0
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < sum(len(t) for _, t in rows)


def test_met_rows_across_frames():
    rng = np.random.default_rng(4)
    keys, size, node = rng.integers(40, size=300) << 20, rng.integers(7, 400, size=300), np.arange(300)
    rows = pd.DataFrame({"cell": line_dedup._packed(keys, size, keys % 3 == 0), "node": node})
    rows = pd.concat([rows, rows[:50]]).sort_values(["cell", "node"])
    whole = pd.concat(line_dedup._met(iter([rows])))
    assert len(whole) == len(whole.drop_duplicates())
    for n in (1, 2, 7):
        parts = pd.concat(line_dedup._met(rows[k : k + n] for k in range(0, len(rows), n)))
        assert parts.values.tolist() == whole.values.tolist()
    together = set()
    for _, g in whole.groupby("cell"):
        together |= {(a, b) for a in g["node"] for b in g["node"] if a < b}
    similar = {(a, b) for a in node for b in node if a < b and keys[a] == keys[b] and 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b])}
    assert similar <= together
