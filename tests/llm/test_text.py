import hashlib
import json
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest

from genpulse.llm import byte_bpe, chat, packing, pii, queries, quality_rules, secrets, tagger

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def text_of(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    from helpers import same_as_duckdb

    same_as_duckdb(spark, SF, queries.QUERIES[name], queries.ORACLES[name])


# quality

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1}
    covered = {k + j for k, w in enumerate(windows) if w in again for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, docs):
    rows = [(0, None), (1, ""), (2, "a b c a b c a"), (3, "x\nx\n\n x\n#<> $"), (4, "é ß é ß é ß")]
    table = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.where("length(text) < 3000").selectExpr("doc_id + 100 AS doc_id", "text"))
    got = {r.doc_id: tuple(r[c] for c in quality_rules.COUNTS) for r in quality_rules.text_counts(table).collect()}
    assert got == {i: brute_counts(t) for i, t in text_of(table).items()}


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.quality(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed").select("doc_id", "kept")
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "good")
    right, n = judged.join(labels, "doc_id").selectExpr("count_if(kept = (good = 1))", "count(*)").first()
    assert right >= 0.97 * n


def test_quality_of_repeats_nulls_and_nothing(repeated, empty):
    assert [r.kept for r in quality_rules.quality(repeated).collect()] == [False] * 5
    assert quality_rules.quality(empty).count() == 0
    assert quality_rules.good_documents(empty).count() == 0


# personal data

def plain_base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and tagger.luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_base_patterns_match_plain_regular_expressions():
    rng = random.Random(1)
    for letters in ("ab.@-1", "12.", "0123456789 -", "+1 ().-2", "a@.b é"):
        for _ in range(400):
            t = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
            assert pii.base_spans(t) == plain_base(t), t


def test_base_patterns_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000):
        pii.base_spans(t)


@pytest.fixture(scope="module")
def weights():
    return tagger.trained()


def test_tagger_on_held_out_spans(weights):
    examples = tagger.Examples(12345)
    pairs = [examples.text(tagger.WINDOW) for _ in range(300)]
    x, y = np.stack([tagger.codes(t) for t, _ in pairs], 1), np.stack([g for _, g in pairs], 1)
    assert (tagger.viterbi(tagger.emissions(x, weights), weights) == y).mean() > 0.95


def test_model_finds_what_patterns_miss(weights):
    text = "hewn ston the +1 (269) 555-3296 4524132264652876 and onrend hested"
    (base, more), = pii.find_all([text], weights)
    assert base == [] and {(k, text[s:e]) for k, s, e in more} == {("phone", "+1 (269) 555-3296"), ("card", "4524132264652876")}


def test_personal_data(spark, docs, repeated, empty, weights):
    rows = [(0, "mail a.b@c.org, ip 10.0.0.1"), (1, None), (2, ""), (3, "x" * 90 + " call +49 170 1234567 now")]
    table = spark.createDataFrame([(i, t, 7, "kept") for i, t in rows], "doc_id long, text string, n_chars int, masked string")
    got = {r.doc_id: r for r in pii.personal_data(table).collect()}
    assert (got[0].n_email, got[0].n_ip, got[0].spans) == (1, 1, "email:5:14,ip:19:27")
    assert got[0].base_sha256 == hashlib.sha256(b"email:5:14,ip:19:27").hexdigest()
    assert got[1].masked is None and got[2].masked == "" and got[3].masked.endswith("call [PHONE] now")
    assert {r.doc_id: r.n_chars for r in pii.mask(table).collect()} == {0: 21, 1: 7, 2: 0, 3: 107}
    assert pii.mask(docs).columns == docs.columns and pii.mask(docs).count() == docs.count()
    assert pii.personal_data(repeated).count() == 5 and pii.personal_data(empty).count() == 0


# chat

def test_escaping_round_trips():
    rng = random.Random(2)
    parts = [*chat.CONTROL, "\\", "<", "[", "INST]", "|im_end|>", "\n", "a"]
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "a\\b\nc", "<|im_end|>", ""]), "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for _ in range(rng.randrange(1, 4))]
        assert chat.read_turns("".join(chat.format_turn(*t)[0] for t in turns)) == turns


RECORDS = [
    {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}], "score": 1},
    {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "ho"}]},
    {"instruction": "do", "input": "this", "output": "done"},
    {"prompt": "hi", "response": "ho", "system": "be"},
    {"data": {"messages": [{"role": "user", "content": "hi"}]}},
]


def test_odd_records(spark):
    deep = "[" * 100_000 + "]" * 100_000
    half = '{"role": "user", "text": "a\\ud800b"}'
    rows = [(1, half), (2, deep), (3, '{"messages": []}'), (4, '{"role": ["x"], "text": {"y": 1}}'), (5, "NaN"), (None, half)]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "id long, record string"), "id", "record")
    got = {r.conv_id: (r.layout, r.text) for r in turns.collect()}
    assert got[1] == got[None] == ("turn", "a\ufffdb")
    assert [got[k][0] for k in (2, 3, 4, 5)] == [None] * 4
    assert chat.unread(turns).agg({"n_records": "sum"}).first()[0] == 4
    assert chat.read_back(chat.format_conversations(turns)).count() == 2


def test_layouts_become_turns(spark, empty):
    rows = [(k, json.dumps(r)) for k, r in enumerate(RECORDS)] + [(90, None), (91, "not json"), (92, '{"other": 1}'), (93, '{"role": null, "text": null}')]
    got = {}
    for r in chat.canonical_turns(spark.createDataFrame(rows, "id long, record string"), "id", "record").orderBy("conv_id", "part").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert [x[1:] for x in got[0]] == [x[1:] for x in got[1]] == [("user", "hi"), ("assistant", "ho")]
    assert [x[1:] for x in got[2]] == [("user", "do\n\nthis"), ("assistant", "done")]
    assert [x[1:] for x in got[3]] == [("system", "be"), ("user", "hi"), ("assistant", "ho")]
    assert [x[1:] for x in got[4]] == [("user", "hi")]
    assert got[90] == got[91] == got[92] == [(None, None, None)] and got[93] == [("turn", "", "")]
    assert chat.read_back(chat.format_conversations(chat.canonical_turns(empty, "doc_id", "text"))).count() == 0


# packing

def test_packing(docs, repeated, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    truth = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4") for i, t in text_of(docs).items()}
    pieces = packing.pack(docs, WORDS, capacity=256, batch_tokens=5000, with_ids=True).collect()
    covered, sequences = {i: [] for i in truth}, {}
    for p in pieces:
        ids = truth[p.doc_id][p.start : p.start + p.length]
        assert (p.ids, p.ids_crc32, p.doc_tokens) == (ids.tolist(), zlib.crc32(ids.tobytes()), len(truth[p.doc_id]))
        covered[p.doc_id].append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, parts in covered.items():
        assert [s for s, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist() and sum(n for _, n in parts) == len(truth[i])
    fills = []
    for parts in sequences.values():
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        fills.append(sum(n for _, n in parts))
    assert max(fills) <= 256 and sum(fills) > 0.9 * 256 * len(fills)
    assert packing.pack(repeated, WORDS).count() == 5 and packing.pack(empty, WORDS).count() == 0


def test_word_encoder_is_the_tokenizer():
    encode, rng = packing.WordEncoder.of(WORDS), random.Random(2)
    parts = list("abÉßΣİ'sS 1½²\n\t<|>!é́ü日本") + ["<|endoftext|>", "'ll", "I'VE"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(1500)]
    assert [x.tolist() for x in encode(texts)] == [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# byte-level BPE

def test_bpe_is_the_library(docs, repeated, empty):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, RANKS, PATTERN).collect()}
    for i, t in text_of(docs).items():
        ids = np.array(library.encode_ordinary(t), "<u4")
        r = got[i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    decoded = {r.doc_id: bytes(r.content).decode() for r in byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()}
    assert decoded == text_of(docs)
    assert byte_bpe.round_trip(repeated, RANKS, PATTERN).count() == 5 and byte_bpe.round_trip(empty, RANKS, PATTERN).count() == 0


def test_bpe_of_odd_texts():
    import tiktoken

    encoder, rng = byte_bpe.Encoder.of(RANKS, PATTERN), random.Random(1)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    letters = "ab' \n\t\x1c\x85 é½1Ⅷ_-.!'s're日🙂̈"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(600)] + ["a" * 2000, "abc" * 300, "!" * 900]
    assert [x.tolist() for x in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_bpe_decodes_in_bounded_parts(monkeypatch):
    encoder = byte_bpe.Encoder.of(RANKS, PATTERN)
    texts = ["one two three four five six " * 9, "", "é 日本 🙂 " * 20, "x"]
    monkeypatch.setattr(byte_bpe, "DECODED", 7)
    assert [b.decode() for b in encoder.decode(encoder.encode(texts))] == texts
    assert encoder.decode([]) == []


def test_bpe_of_many_long_words():
    import tiktoken

    encoder, rng = byte_bpe.Encoder(RANKS, PATTERN), random.Random(3)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(240)) for _ in range(1500)]
    assert encoder.encode([" ".join(words)])[0].tolist() == library.encode_ordinary(" ".join(words))


def test_bpe_of_very_long_words(monkeypatch):
    """Parts between places that no token crosses, and queries that stop between rounds."""
    import tiktoken

    encoder, rng = byte_bpe.Encoder(RANKS, PATTERN), random.Random(5)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    tokens = [t.decode() for t in encoder.ranks if t.isalpha() and t.isascii()]
    texts = ["".join(rng.choice(tokens) for _ in range(3000)), "".join(rng.choice("etaoin") for _ in range(9000)), "=" * 20_001, "日本語の文章" * 900, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40_000))]
    want = [library.encode_ordinary(t) for t in texts]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    word = texts[0].encode()
    assert b"".join(encoder.parts(word)) == word and len(encoder.parts(word)) > 100
    monkeypatch.setattr(byte_bpe, "LONGEST", 3)
    monkeypatch.setattr(byte_bpe, "LETTERS", 4000)
    monkeypatch.setattr(byte_bpe, "QUERY_ROWS", 20_000)
    assert [x.tolist() for x in byte_bpe.Encoder(RANKS, PATTERN).encode(texts)] == want


# secrets

def plain_secrets(t):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_secret_patterns():
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "=", ": ", '"', "AKIA", "ABCDEFGH01234567", "deadbeef00112233", "x", " ", "\n", "ab12"]
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(10)))
        assert secrets.base_spans(t) == plain_secrets(t)
    secrets.base_spans("password " * 50_000 + "a" * 200_000)


def test_weak_parts_need_a_complement(spark, repeated, empty):
    loose, far = "Zx9Kq2Lw8Vb4Nm6Ty1Rp", " filler" * 100
    rows = [(0, f"username = alice1 then {loose} there"), (1, f"username = alice1{far}{loose}"), (2, loose), (3, f"https://db.example.com/x and {loose}"), (4, None), (5, "token = 'abcdefghijklmnop'")]
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_linked for i in range(6)] == [2, 0, 0, 2, 0, 0]
    assert got[0].spans == "identifier:0:17,secret:23:43" and got[5].n_assign == 1
    assert secrets.find_secrets(repeated).count() == 5 and secrets.find_secrets(empty).count() == 0


def test_any_number_of_blanks_links_as_one_does():
    for blanks in (0, 1, 9, 300):
        text = f"username{' ' * blanks}={' ' * blanks}alice1 pwd=Zx9Kq2Lw8Vb4Nm6Ty1Rp"
        assert {kind for _, _, kind in secrets.weak_parts(text, [])} == {"identifier", "secret"}
    began = time.perf_counter()
    secrets.weak_parts("username" + " " * 3_000_000 + "x", [])
    assert time.perf_counter() - began < 5


def test_links_against_brute_force(spark):
    rng = random.Random(6)
    parts = []
    for row in range(40):
        for _ in range(rng.randrange(1, 25)):
            first = rng.randrange(4000)
            parts.append((row, rng.choice(["identifier", "endpoint", "secret", "access", "assign", "hex"]), first, first + rng.choice([1, 8, 60, 900])))
    parts = sorted(set(parts))
    sort = lambda k: {"access": "identifier", "assign": "secret", "hex": "secret"}.get(k, k)
    want = set()
    for row, kind, first, last in parts:
        needs = {"secret": {"identifier", "endpoint"}}.get(kind, {"secret"})
        if kind in secrets.WEAK and any(r == row and sort(k) in needs and f <= last + 200 and e >= first - 200 for r, k, f, e in parts):
            want.add((row, kind, first, last))
    got = secrets.linked(spark.createDataFrame(parts, "row long, kind string, first int, last int")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and 0 < len(want) < len(parts)


def test_weak_parts_in_environment_files_and_long_tokens(spark):
    loose = "Zx9Kq2Lw8Vb4Nm6Ty1Rp"
    rows = [(0, f"username=alice1 pwd={loose}"), (1, f"username = alice1 {loose * 25}"), (2, f"https://h.example.com/x?sig={loose}&v=1"), (3, f"postgres://u:{loose}@h/db"), (4, f"pwd={loose}"), (5, f"user=alice1 x={loose}==")]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        0: "identifier:0:15,secret:20:40",
        1: "identifier:0:17,secret:18:518",
        2: "endpoint:0:28,secret:28:48",
        3: "endpoint:0:13,secret:13:33",
        4: "",
        5: "identifier:0:11,secret:14:36",
    }
    secrets.weak_parts("a=" * 100_000 + "aB3" * 300_000 + "=" * 100_000, [])
