"""Cost-balanced packing of tokenised documents into training sequences.

A document costs linear * n + quadratic * n**2 for its n tokens, as attention within a document
does. Documents, the dearest first, each go to the sequence of least cost that still has room.
A document longer than a sequence is cut into full sequences and a rest, and one that finds no
room whole is cut over the cheapest sequences that have some, so that at most one sequence's
worth of tokens of padding is left in each batch.

Packing needs no order between documents, so nothing is shuffled: every task packs what it reads
in batches of a bounded number of tokens. A task keeps one batch in memory, whatever the sources
or groups in its rows, and a lost task only packs its own rows again, to the same result.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import only

CAPACITY, END_ID = 4096, 2
#: Cost of a token, and of a pair of tokens of one document, in units of a token's cost.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Tokens that one batch holds before it is packed; rows of a task encoded at once; words remembered.
BATCH_TOKENS, ROWS, WORDS = 1 << 20, 64, 600_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write a byte: printable ones as themselves, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts under a lower-casing BPE tokenizer whose splits never cross ASCII white space.

    Such a tokenizer gives a text the ids of its words in turn, and a word those of its pieces, so
    each different word and piece is encoded once and remembered, up to `limit` of them, for all
    the tasks of a Python worker. Words of plain Latin characters, which normalisation leaves as
    they are but for their case, go to the library's BPE model piece by piece; all others to the
    whole tokenizer.
    """

    _words = re.compile(r"[^ \t\n\r\x0b\x0c]+")
    _plain = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    _pieces = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    _split = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _made: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str, limit: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known, self.pieces = Tokenizer.from_file(path), limit, {}, {}
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        steps = [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
        splits = (config["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_piece = steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"] == {"Regex": self._split}
        self.special = [t["content"] for t in config["added_tokens"]]
        self.letters = str.maketrans(_byte_letters())

    def _ids(self, word: str) -> bytes:
        if not (self.by_piece and self._plain.fullmatch(word)) or any(t in word for t in self.special):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        out = []
        for piece in self._pieces.findall(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                written = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                ids = self.pieces[piece] = array("I", [t.id for t in self.tokenizer.model.tokenize(written)]).tobytes()
            out.append(ids)
        return b"".join(out)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._words.findall(t) for t in texts]
        if len(self.known) + len(self.pieces) > self.limit:
            self.known, self.pieces = {}, {}
        known = self.known
        for w in {w for words in split for w in words if w not in known}:
            known[w] = self._ids(w)
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype="<u4") for words in split]


def balance(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    out: list[tuple[int, int, int, int, int]] = []
    sequence, rest = 0, []
    for d, n in enumerate(lengths.tolist()):
        for start in range(0, n - capacity + 1, capacity):
            out.append((d, start, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, d, n - n % capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    total = sum(n for n, _, _ in rest)
    used = {sequence + k: 0 for k in range(-(-total // capacity))}
    cheapest = [(0.0, s) for s in used]
    for n, d, start in rest:
        passed, whole = [], None
        while cheapest:
            cost, s = heapq.heappop(cheapest)
            if capacity - used[s] >= n:
                whole = s
                break
            passed.append((cost, s))
        if whole is not None:
            out.append((d, start, n, whole, used[whole]))
            used[whole] += n
            if used[whole] < capacity:
                heapq.heappush(cheapest, (cost + linear * n + quadratic * n * n, whole))
        else:
            while n:  # cut over the cheapest sequences
                cost, s = passed.pop(0)
                part = min(n, capacity - used[s])
                out.append((d, start, part, s, used[s]))
                used[s] += part
                n, start = n - part, start + part
                if used[s] < capacity:
                    passed.append((cost + linear * part + quadratic * part * part, s))
        for item in passed:
            heapq.heappush(cheapest, item)
    return out


def _batch(ids: list, tokens: list[np.ndarray], first: int, capacity: int, linear: float, quadratic: float, with_ids: bool) -> pd.DataFrame:
    pieces = balance(np.array([len(t) for t in tokens], dtype=np.int64), capacity, linear, quadratic)
    parts = [tokens[d][s : s + n] for d, s, n, _, _ in pieces]
    out = pd.DataFrame(
        {
            "doc_id": pd.array([ids[p[0]] for p in pieces], dtype="Int64"),
            "start": [p[1] for p in pieces],
            "length": [p[2] for p in pieces],
            "ids_crc32": [zlib.crc32(x.tobytes()) for x in parts],
            "doc_tokens": [len(tokens[p[0]]) for p in pieces],
            "sequence_id": [first + p[3] for p in pieces],
            "offset": [p[4] for p in pieces],
        }
    )
    if with_ids:
        out["ids"] = [x.astype(np.int32) for x in parts]
    return out


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    batch_tokens: int = BATCH_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, ids_crc32,
    doc_tokens, sequence_id, offset; with_ids adds the ids themselves.

    A document is its text's ids and end_id; a null or empty text is end_id alone. Every id lies
    in one piece, and a sequence's pieces follow one another from offset 0 without gaps. Repeated
    rows are packed as documents of their own; a null identifier stays null; an empty table gives
    an empty result. Sequence identifiers are unique, not consecutive.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, ids, tokens, held = WordEncoder.of(tokenizer_path), [], [], 0
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for frame in frames:
            for at in range(0, len(frame), ROWS):
                some = frame.iloc[at : at + ROWS]
                for i, t in zip(some["doc_id"], encode(some["text"].fillna("").tolist())):
                    tokens.append(np.append(t, np.uint32(end_id)))
                    ids.append(None if pd.isna(i) else int(i))
                    held += len(tokens[-1])
                if held >= batch_tokens:
                    done = _batch(ids, tokens, sequence, capacity, linear, quadratic, with_ids)
                    yield done
                    ids, tokens, held, sequence = [], [], 0, int(done["sequence_id"].max()) + 1
        if tokens:
            yield _batch(ids, tokens, sequence, capacity, linear, quadratic, with_ids)

    return only(documents, id_col, text_col).mapInPandas(run, schema)
