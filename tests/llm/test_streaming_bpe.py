import random
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from genpulse.llm import streaming_bpe as sb

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["é", "é", "İ", "ß", "日本", "\xa0", " ", "'s", "'LL", "<|endoftext|>", "<|endof", "3", "４", "...", "=", "́", "Σ", "각", "가", "가", "😀", "\x1c", "A", "B", "\n", "</w>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture
def tiny(monkeypatch):
    """An encoder whose windows and slices are so small that texts of a few hundred characters cross many."""
    monkeypatch.setattr(sb, "SLICE", 150)
    return sb.StreamingEncoder(PATH, block=16)


def ids_of(encoder, text):
    return [i for part in encoder(text) for i in array("I", part)]


def hard_texts(seed, n):
    rng = random.Random(seed)
    tokens = [t for t in sb.StreamingEncoder.of(PATH).tokens.values() if t.isascii()]
    tokens = [t.removesuffix("</w>") for t in tokens]
    for k in range(n):
        yield [
            lambda: "".join(rng.choice(tokens) for _ in range(rng.randint(1, 400))),
            lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 3000))),
            lambda: " ".join(rng.choice(tokens) * rng.randint(1, 4) for _ in range(rng.randint(1, 60))),
            lambda: "".join(rng.choice(ODD) for _ in range(rng.randint(1, 900))),
            lambda: rng.choice(["=", "a", "ab", "-_", "0", "aaab'", "the", "日"]) * rng.randint(1, 900),
        ][k % 5]()


def test_windows_give_the_librarys_ids_and_text(tiny, library):
    for text in hard_texts(4, 300):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(tiny, text) == want
        machine = sb.Decoder(tiny.tokens)
        assert "".join(machine.feed([i]) for i in want) + machine.finish() == library.decode(want, skip_special_tokens=False)


def test_the_lookahead_suffices_and_a_shorter_one_does_not():
    # each letter's merge waits for the one after it: a chain as long as the list
    letters = "abcdefgh"
    base = {c: k for k, c in enumerate(letters)}
    chain = [(base[x], base[y], 10 + k) for k, (x, y) in enumerate(reversed(list(zip(letters, letters[1:]))))]
    merges = sb.Merges(chain, dict.fromkeys(base.values(), 1))
    assert merges.lookahead == len(letters) - 1
    whole, cut = [base[c] for c in letters], [base[c] for c in letters[:-1]]
    assert merges.apply(whole)[0] != merges.apply(cut)[0]
    last = {i: i for i in base.values()}
    for word in (whole * 9, cut * 9, [base[c] for c in "abababcdefgabcdefgh"] * 7):
        machine = sb.Transducer(merges, last, block=1)
        assert [t for part in machine.feed(word) for t in part] + machine.finish() == merges.apply(word)


def test_random_merge_lists_are_stable_behind_their_lookahead():
    rng = random.Random(2)
    for _ in range(60):
        tokens, size, merges, seen = list(range(4)), dict.fromkeys(range(4), 1), [], set()
        for made in range(4, 4 + rng.randint(3, 25)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if (u, v) not in seen:
                seen.add((u, v))
                merges.append((u, v, made))
                tokens.append(made)
        table = sb.Merges(merges, size)
        for _ in range(20):
            word = [rng.randrange(4) for _ in range(rng.randint(1, 200))]
            machine = sb.Transducer(table, {i: i for i in range(4)}, block=1)
            assert [t for part in machine.feed(word) for t in part] + machine.finish() == table.apply(word)


def test_a_list_that_uses_tokens_before_they_are_made_is_refused():
    with pytest.raises(ValueError):
        sb.Merges([(0, 9, 8), (1, 2, 9)], {0: 1, 1: 1, 2: 1})


def test_a_long_word_takes_a_bounded_window(library):
    encoder, most = sb.StreamingEncoder(PATH), 0
    for _ in encoder("ab" * 200_000):
        most = max(most, len(encoder.transducer.held))
    assert most <= encoder.merges.lookahead + 2 * sb.BLOCK
    assert ids_of(encoder, "ab" * 50_000) == library.encode("ab" * 50_000, add_special_tokens=False).ids


def test_parts_round_trip_through_tables(spark, docs, library):
    long = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.repeat("text", 200)).otherwise(F.col("text")))
    parts = sb.encoded(long, PATH, part_tokens=64)
    assert parts.where("part > 0").count() > 10
    texts = {r.doc_id: r.text for r in long.collect()}
    plain = {}
    for r in sorted(sb.decoded(parts, PATH).collect(), key=lambda r: (r.doc_id, r.part)):
        plain[r.doc_id] = plain.get(r.doc_id, "") + r.text
    spelt = lambda text: "".join((library.normalizer.normalize_str(text or "")).split())
    assert {i: "".join(t.split()) for i, t in plain.items()} == {i: spelt(t) for i, t in texts.items()}


def test_query_columns_against_the_library(spark, docs, library):
    from hashlib import sha256

    for r in sb.streaming_round_trip(docs, PATH).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(array("I", ids).tobytes()).hexdigest())
        assert r.decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_repeats_nulls_and_empty_tables(repeated, empty):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in sb.streaming_round_trip(repeated, PATH).collect()) == [(False, 1, 2), (False, 1, 2), (False, 2, 0), (True, 0, 0), (True, 0, 2)]
    assert sb.streaming_round_trip(empty, PATH).count() == sb.encoded(empty, PATH).count() == 0
