"""Byte-level BPE encoding and decoding by recursive queries.

Each task keeps one in-memory DuckDB with the vocabulary and its merge table: every pair of
tokens whose bytes together are a token, with that token's rank. The different words of the rows
it reads become rows (word, position, token); a recursive query joins neighbours to the merge
table and contracts each word's leftmost pair of least rank, until no word has a pair left.
Decoding joins ids to the vocabulary and concatenates in order. Nothing is shuffled, and the words
of a task are encoded once, however often they occur.

A long word is cut first where no token of the vocabulary, wherever it occurs in the word, crosses:
no contraction can cross there either. Parts that are still long go through a second recursive
query, which contracts all the pairs of least rank in a round that cannot be told apart from
contracting them one by one, and which stops after so many rounds that its rows stay bounded; the
next query takes up where it stopped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import only

#: Unicode's White_Space, as the tokenizer's pattern means \s.
SPACE = "\t-\r \x85\xa0  -     　"
#: A text falls into these chunks, and no match of the tokenizer's pattern crosses a chunk.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Rows that one recursive query may make, for short words counted as the square of their bytes; bytes
#: from which a word is long; chunks and words remembered; text encoded at once.
QUERY_ROWS, LONGEST, CHUNKS, BATCH_CHARS = 8_000_000, 64, 1_200_000, 4_000_000
#: Ids of one decoding query; letters of one query of long words, more where a single part is longer.
DECODED, LETTERS = 1_000_000, 500_000

CONTRACT = """
WITH RECURSIVE step(word, pos, tok, next_pos, place, merged, round) AS (
    SELECT l.word, l.pos, l.tok, l.next_pos, m.merged::BIGINT * 65536 + l.pos, m.merged, 0
    FROM (SELECT *, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos FROM letters WINDOW w AS (PARTITION BY word ORDER BY pos)) l
    LEFT JOIN merges m ON m.first = l.tok AND m.second = l.next_tok
    UNION ALL
    SELECT n.word, n.pos, n.tok, n.next_pos, m.merged::BIGINT * 65536 + n.pos, m.merged, n.round
    FROM (
        SELECT k.*, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos
        FROM (
            SELECT s.word, s.pos, CASE WHEN s.place = b.best THEN s.merged ELSE s.tok END AS tok, s.round + 1 AS round
            FROM step s JOIN (SELECT word, min(place) AS best, arg_min(next_pos, place) AS gone FROM step WHERE place IS NOT NULL GROUP BY word) b ON s.word = b.word
            WHERE s.pos <> b.gone) k
        WINDOW w AS (PARTITION BY word ORDER BY pos)) n
    LEFT JOIN merges m ON m.first = n.tok AND m.second = n.next_tok)
SELECT s.word, s.tok FROM step s JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) l ON s.word = l.word AND s.round = l.round ORDER BY s.word, s.pos
"""
#: A round contracts every other one of neighbouring pairs of the least rank, from the left, as one by
#: one would; but only the leftmost where the new token may at once be part of a pair of lesser rank.
CONTRACT_LONG = """
WITH RECURSIVE step(word, pos, tok, merged, round) AS (
    SELECT l.word, l.pos, l.tok, m.merged, 0
    FROM (SELECT *, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS next_tok FROM letters) l
    LEFT JOIN merges m ON m.first = l.tok AND m.second = l.next_tok
    UNION ALL
    SELECT n.word, n.pos, n.tok, m.merged, n.round
    FROM (
        SELECT word, pos, round, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS next_tok
        FROM (
            SELECT word, pos, round + 1 AS round, CASE WHEN chosen THEN merged ELSE tok END AS tok, coalesce(lag(chosen) OVER (PARTITION BY word ORDER BY pos), false) AS gone
            FROM (
                SELECT *, least_rank AND CASE WHEN alone THEN place = min(CASE WHEN least_rank THEN place END) OVER (PARTITION BY word)
                    ELSE (place - coalesce(max(CASE WHEN NOT least_rank THEN place END) OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1 END AS chosen
                FROM (
                    SELECT s.*, coalesce(s.merged = b.best, false) AS least_rank, e.tok IS NOT NULL AS alone, row_number() OVER (PARTITION BY s.word ORDER BY s.pos) AS place
                    FROM step s JOIN (SELECT word, min(merged) AS best FROM step WHERE merged IS NOT NULL GROUP BY word) b ON s.word = b.word
                    LEFT JOIN eager e ON e.tok = b.best
                    WHERE s.round < $rounds)))
        WHERE NOT gone) n
    LEFT JOIN merges m ON m.first = n.tok AND m.second = n.next_tok)
SELECT s.word, s.pos, s.tok, s.merged IS NOT NULL AS more FROM step s JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) l ON s.word = l.word AND s.round = l.round ORDER BY s.word, s.pos
"""
DECODE = "SELECT string_agg(v.hex, '' ORDER BY i.pos) AS hex FROM ids i JOIN vocabulary v ON v.tok = i.tok GROUP BY i.doc ORDER BY i.doc"


def word_pattern(pattern: str):
    """The tokenizer's pattern, its white space spelt out so that every engine means the same."""
    import regex

    return regex.compile(pattern.replace(r"\S", f"[^{SPACE}]").replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]"))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of texts and texts of ids, under ranks and a pattern; one for each Python worker."""

    _made: dict[tuple[str, str], Encoder] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks, self.pattern, self.known, self.pieces = read_ranks(path), word_pattern(pattern), {}, {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        merges = pd.DataFrame(pairs, columns=["first", "second", "merged"], dtype="int32")  # noqa: F841  read by name
        vocabulary = pd.DataFrame({"tok": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]}).astype({"tok": "int32"})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        # tokens that form a pair of lesser rank than their own with some neighbour
        self.db.execute("CREATE TABLE eager AS SELECT first AS tok FROM merges WHERE merged < first UNION SELECT second FROM merges WHERE merged < second")
        self.occurrences = None
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian ids of each word. A word that is a token is that token."""
        out = {w: np.array([self.ranks[w]], "<u4").tobytes() for w in words if w in self.ranks}
        rest = [w for w in words if w not in out]
        parts = {w: self.parts(w) for w in rest if len(w) > LONGEST}
        single = list(dict.fromkeys([w for w in rest if w not in parts] + [p for ps in parts.values() for p in ps]))
        ids = self.contracted([w for w in single if len(w) <= LONGEST]) | self.contracted_long([w for w in single if len(w) > LONGEST])
        out.update((w, b"".join([ids[p] for p in parts[w]]) if w in parts else ids[w]) for w in rest)
        return out

    def parts(self, word: bytes) -> list[bytes]:
        """The word, cut at every place that no token which occurs in it crosses."""
        import ahocorasick

        if self.occurrences is None:
            self.occurrences = ahocorasick.Automaton()
            for token in self.ranks:
                self.occurrences.add_word(token.decode("latin-1"), len(token))
            self.occurrences.make_automaton()
        first = array("q", range(len(word)))  # where the longest token that ends here begins
        for end, size in self.occurrences.iter(word.decode("latin-1")):
            if end + 1 - size < first[end]:
                first[end] = end + 1 - size
        reached = np.minimum.accumulate(np.frombuffer(first, dtype=np.int64)[::-1])[::-1]
        cuts = np.flatnonzero(reached >= np.arange(len(word))).tolist()
        return [word[s:e] for s, e in zip(cuts, [*cuts[1:], len(word)])]

    def letters(self, words: list[bytes]) -> pd.DataFrame:
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        return pd.DataFrame(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                "pos": (np.arange(sizes.sum()) - np.repeat(starts, sizes)).astype(np.int32),
                "tok": self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)],
            }
        )

    def contracted(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian ids of short words, by one contraction of each word a round."""
        out = {}
        for some in _shares(words, [len(w) ** 2 for w in words], QUERY_ROWS):
            letters = self.letters(some)  # noqa: F841  read by name
            got = self.db.execute(CONTRACT).fetchnumpy()
            out.update(_of_words(some, got["word"], got["tok"]))
        return out

    def contracted_long(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian ids of long words, by a bounded number of rounds a query. Memory is bounded
        too, but for a single word of over a million letters that nothing cuts, such as a ruler of
        dashes: it takes what its letters take in one round."""
        out = {}
        for some in _shares(words, [len(w) for w in words], LETTERS):
            letters, done = self.letters(some), []
            self.db.execute(f"SET memory_limit='{max(500, len(letters) // 2000)}MB'")
            while len(letters):
                got = self.db.execute(CONTRACT_LONG, {"rounds": max(1, QUERY_ROWS // len(letters))}).fetchnumpy()
                open_ = np.zeros(len(some), dtype=bool)
                open_[got["word"][got["more"]]] = True
                still = open_[got["word"]]
                done.append((got["word"][~still], got["tok"][~still]))
                letters = pd.DataFrame({c: got[c][still] for c in ("word", "pos", "tok")})
            word, tok = (np.concatenate([d[k] for d in done]) for k in (0, 1))
            order = np.argsort(word, kind="stable")
            out.update(_of_words(some, word[order], tok[order]))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [CHUNK.findall(t) for t in texts]
        if len(self.known) + len(self.pieces) > CHUNKS:
            self.known, self.pieces = {}, {}
        known, ids = self.known, self.pieces
        new = {c for chunks in split for c in chunks if c not in known}
        pieces = {c: [p.encode("utf-8", "replace") for p in self.pattern.findall(c)] for c in new}
        ids.update(self.words(list({p for ps in pieces.values() for p in ps if p not in ids})))
        for c, ps in pieces.items():
            known[c] = b"".join([ids[p] for p in ps])
        return [np.frombuffer(b"".join([known[c] for c in chunks]), dtype="<u4") for chunks in split]

    def decode(self, tokens: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids. A query takes DECODED ids at most, so a long text is
        decoded in several parts, and its memory is bounded."""
        parts = [(doc, t[k : k + DECODED]) for doc, t in enumerate(tokens) for k in range(0, len(t), DECODED)]
        out: list[list[bytes]] = [[] for _ in tokens]
        at = 0
        while at < len(parts):
            until, held = at, 0
            while until < len(parts) and (until == at or held + len(parts[until][1]) <= DECODED):
                held += len(parts[until][1])
                until += 1
            some = parts[at:until]
            ids = pd.DataFrame(  # noqa: F841  read by name
                {
                    "doc": np.repeat(np.arange(len(some), dtype=np.int32), [len(t) for _, t in some]),
                    "pos": np.arange(held, dtype=np.int64),
                    "tok": np.concatenate([t for _, t in some]).astype(np.int32),
                }
            )
            for (doc, _), (text,) in zip(some, self.db.execute(DECODE).fetchall()):
                out[doc].append(bytes.fromhex(text))
            at = until
        return [b"".join(found) for found in out]


def _shares(words: list[bytes], costs: list[int], most: int) -> Iterator[list[bytes]]:
    """The words in order, in lists of about `most` cost."""
    at = np.cumsum(costs, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(words)] if words else []
    yield from (words[s:e] for s, e in zip(cuts, cuts[1:]))


def _of_words(words: list[bytes], word: np.ndarray, tok: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids, from rows that come sorted by the word's number."""
    ids = np.ascontiguousarray(tok).astype("<u4")
    ends = np.searchsorted(word, np.arange(len(words)), side="right").tolist()
    return ((w, ids[s:e].tobytes()) for w, s, e in zip(words, [0, *ends[:-1]], ends))


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for frame in frames:
        for i, t in zip(frame["doc_id"], frame["text"]):
            ids.append(None if pd.isna(i) else int(i))
            texts.append(t or "")
            held += len(texts[-1])
            if held >= BATCH_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encode(documents: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids array<int>. A null text has no ids, as an empty one;
    repeated rows and null identifiers are rows of their own; an empty table gives an empty result."""

    def run(frames):
        encoder = Encoder.of(ranks_path, pattern)
        for doc, texts in _batches(frames):
            yield pd.DataFrame({"doc_id": pd.array(doc, "Int64"), "ids": [t.astype(np.int32) for t in encoder.encode(texts)]})

    return only(documents, id_col, text_col).mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, content binary of each row of encode(): the bytes, which need not be valid UTF-8
    where ids were cut."""

    def run(frames):
        encoder = Encoder.of(ranks_path, pattern)
        for frame in frames:
            for at in range(0, len(frame), 256):
                some = frame.iloc[at : at + 256]
                tokens = [np.asarray(t if t is not None else [], dtype=np.int32) for t in some["ids"]]
                yield pd.DataFrame({"doc_id": some["doc_id"].astype("Int64"), "content": encoder.decode(tokens)})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, content binary")


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, and decoded from the ids
    alone. Rows as encode() has them; a lone surrogate counts as a question mark."""

    def run(frames):
        encoder = Encoder.of(ranks_path, pattern)
        for doc, texts in _batches(frames):
            tokens = encoder.encode(texts)
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(doc, "Int64"),
                    "n_tokens": [len(t) for t in tokens],
                    "ids_sha256": [hashlib.sha256(t.tobytes()).hexdigest() for t in tokens],
                    "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in encoder.decode(tokens)],
                }
            )

    return only(documents, id_col, text_col).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
