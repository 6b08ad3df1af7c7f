"""BPE with word ends as a streaming transducer, and an incremental decoder.

A merge list bounds how far the text after a position can change the tokens before it. Merges run
in order of rank, so where two texts agree up to a position, what differs behind it works its way
to the left by merges (u, v) of rising rank: each time v begins where the texts part, and u, which
both have, ends there. Every v of the next merge has the u before it at its left edge. The longest
chain of such merges, found in one walk over the list, is the lookahead: a token that ends that
many symbols before the end of what has been read is a token of the whole text.

The transducer holds the symbols of one window, of the lookahead and a block. It emits what has
become stable, and starts anew behind it, as the tokens after a boundary are those of the text
after it. So a word of any length takes constant memory. Words that fit a window, which is nearly
all of them, are remembered, up to a bounded number in a Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import only
from .packing import _byte_letters

#: Symbols of a window beside the lookahead; characters of a text that are split at once; words remembered.
BLOCK, SLICE, WORDS = 2048, 1 << 16, 300_000
#: Symbols up to which looking through all pairs of a word is faster than keeping them in a queue.
SHORT = 64
#: Tokens of a row of encoded(), about.
PART_TOKENS = 1 << 16

ENDS = "</w>"
#: Letters that neither combine with what stands before them nor change class in lower case.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿΑ-ΡΣ-Ωα-ωА-яא-תء-يก-ะぁ-ゖァ-ヺ一-鿿가-힣"
_MARK = r"!-&(-/:-@\[-`{-~"
#: Where a slice may end: at white space, or in a word inside letters (no contraction ends there), between digits or inside marks.
_CUT = re.compile(rf"[ \t\n\r\x0b\x0c]|(?<=[{_LETTER}]{{4}})(?=[{_LETTER}])|(?<=[0-9])(?=[0-9])|(?<=[{_MARK}])(?=[{_MARK}])")


class Merges:
    """A merge list over numbered symbols: pairs to (rank, token), sizes of tokens in symbols, and
    the lookahead that suffices. Every token of the list must be made before it is used."""

    def __init__(self, merges: Iterable[tuple[int, int, int]], size: dict[int, int]):
        """merges: (left, right, made) in order of rank; size: symbols of the tokens that no merge makes."""
        self.pairs: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.size, self.lookahead = dict(size), 1
        first: dict[int, int] = {}
        reach: dict[int, int] = {}
        for rank, (u, v, made) in enumerate(merges):
            if u not in self.size or v not in self.size or made in self.size:
                raise ValueError(f"merge {rank} is not of tokens made before it, or makes a token again")
            furthest, edge = 0, v
            while edge is not None:
                furthest, edge = max(furthest, reach.get(edge, 0)), first.get(edge)
            reach[u] = max(reach.get(u, 0), self.size[u] + furthest)
            self.lookahead = max(self.lookahead, reach[u])
            self.pairs[u, v], self.size[made], first[made] = rank, self.size[u] + self.size[v], u
            self.made.append(made)

    def apply(self, symbols: list[int]) -> list[int]:
        """Tokens of symbols: the leftmost pair of least rank is merged until none is left."""
        return self._scanned(symbols) if len(symbols) <= SHORT else self._queued(symbols)

    def _scanned(self, symbols: list[int]) -> list[int]:
        rank, made, none, tokens = self.pairs.get, self.made, len(self.made), list(symbols)
        ranks = [rank(p, none) for p in zip(tokens, tokens[1:])]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            tokens[k : k + 2] = [made[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((tokens[k - 1], tokens[k]), none)
            if k < len(ranks):
                ranks[k] = rank((tokens[k], tokens[k + 1]), none)
        return tokens

    def _queued(self, symbols: list[int]) -> list[int]:
        n, pairs, tokens = len(symbols), self.pairs, list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank, k) for k, rank in enumerate(map(pairs.get, zip(symbols, symbols[1:]))) if rank is not None]
        heapify(queue)
        while queue:
            rank, k = heappop(queue)
            j = after[k]
            if tokens[k] < 0 or j == n or pairs.get((tokens[k], tokens[j])) != rank:
                continue
            tokens[k], tokens[j], after[k] = self.made[rank], -1, after[j]
            if after[j] < n:
                before[after[j]] = k
                if (found := pairs.get((tokens[k], tokens[after[j]]))) is not None:
                    heappush(queue, (found, k))
            if before[k] >= 0 and (found := pairs.get((tokens[before[k]], tokens[k]))) is not None:
                heappush(queue, (found, before[k]))
        return [t for t in tokens if t >= 0]


class Transducer:
    """Reads a word's symbols in parts and emits its tokens as soon as they are stable."""

    def __init__(self, merges: Merges, last: dict[int, int], block: int = BLOCK):
        """last: the symbol that stands for a symbol at the end of a word."""
        self.merges, self.last, self.block, self.held = merges, last, block, []

    def feed(self, symbols: list[int]) -> Iterator[list[int]]:
        window = self.merges.lookahead + self.block
        for at in range(0, len(symbols), self.block):
            self.held += symbols[at : at + self.block]
            if len(self.held) > window:
                out, end, stable = [], 0, len(self.held) - self.merges.lookahead
                for token in self.merges.apply(self.held):
                    if end + self.merges.size[token] > stable:
                        break
                    end += self.merges.size[token]
                    out.append(token)
                self.held = self.held[end:]
                yield out

    def finish(self) -> list[int]:
        """The rest of the word's tokens; the next feed begins a new word."""
        held, self.held = self.held, []
        if held:
            held[-1] = self.last[held[-1]]
        return self.merges.apply(held)


class Remembered(dict):
    """What has been worked out, in two generations: when the younger is full it becomes the older,
    and what is asked for again moves over. So common words stay, however many rare ones pass."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def found(self, key: str) -> bytes | None:
        """The value of a key that may be in either generation, which is in the younger after that."""
        value = self.get(key)
        if value is None and (value := self.older.pop(key, None)) is not None:
            self[key] = value
        return value

    def aged(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class StreamingEncoder:
    """Ids of texts under a lower-casing BPE tokenizer with word ends, whose splits never cross
    ASCII white space, in parts of bounded size."""

    _words = re.compile(r"[^ \t\n\r\x0b\x0c]+")
    #: Words that normalisation leaves as they are but for their case, and their pieces.
    _plain = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    _pieces = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    #: The normaliser and splits that the patterns above follow.
    _steps = ["NFC", "Replace", "Lowercase"]
    _split = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, block: int = BLOCK, limit: int = WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        splits = config["pre_tokenizer"]["pretokenizers"]
        if [n["type"] for n in config["normalizer"]["normalizers"]] != self._steps or splits[0]["pattern"] != {"Regex": self._split} or config["model"]["end_of_word_suffix"] != ENDS:
            raise ValueError("the transducer follows lower-casing tokenizers that split words by letters, digits and marks, and end them")
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        ids = config["model"]["vocab"]
        self.letters = str.maketrans(_byte_letters())
        self.symbols = {letter: ids[letter] for letter in _byte_letters().values()}
        last = {i: ids[letter + ENDS] for letter, i in self.symbols.items()}
        ordered = ((ids[u], ids[v], ids[u + v]) for u, v in map(lambda m: m.split(" ") if isinstance(m, str) else m, config["model"]["merges"]))
        self.merges = Merges(ordered, dict.fromkeys([*self.symbols.values(), *last.values()], 1))
        self.transducer = Transducer(self.merges, last, block)
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.known, self.pieces = Remembered(limit), Remembered(limit)

    @staticmethod
    @cache
    def of(path: str) -> StreamingEncoder:
        """One encoder of a Python worker, for all its tasks."""
        return StreamingEncoder(path)

    def _cuts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in slices, each with whether its last word goes on in the next. Slices end at
        white space; a longer word is cut where neither normalisation nor splitting looks across."""
        at = 0
        while at < len(text):
            end, open_ended = at + SLICE, False
            if end < len(text):
                blank = max(text.rfind(c, at, end) for c in " \n\t\r\x0b\x0c")
                if blank > at:
                    end = blank
                else:
                    end, open_ended = self._cut_in_word(text, end)
            yield text[at:end], open_ended
            at = end

    def _cut_in_word(self, text: str, start: int) -> tuple[int, bool]:
        for cut in _CUT.finditer(text, start):
            k = cut.start()
            if cut.end() > k:
                return k, False
            if not any(text.find(s, max(k - len(s) + 1, 0), k + len(s) - 1) >= 0 for s in self.special):
                return k, not text[k].isdigit()
        return len(text), False

    def _split_word(self, word: str) -> list[str]:
        """Pieces of a word in byte letters, or special tokens as they are."""
        if self._plain.fullmatch(word):
            pieces = self._pieces.findall(word.lower())
            return pieces if word.isascii() else [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return [piece for piece, _ in self.split(self.normalise(word))]

    def _whole(self, piece: str) -> bytes:
        ids = self.pieces.found(piece)
        if ids is None:
            out = [t for part in self.transducer.feed([self.symbols[c] for c in piece]) for t in part]
            ids = array("I", out + self.transducer.finish()).tobytes()
            if len(piece) <= BLOCK:
                self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if "<" not in word:
            return b"".join([self._whole(p) for p in self._split_word(word)])
        out = []
        for part in self._specials.split(word):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                out += [self._whole(p) for p in self._split_word(part)]
        return b"".join(out)

    def __call__(self, text: str) -> Iterator[bytes]:
        """Ids of the text, as little-endian 32-bit numbers, in parts that together are all of them."""
        going_on = False
        for piece, open_ended in self._cuts(text):
            self.known.aged()
            self.pieces.aged()
            words, known = self._words.findall(piece), self.known
            if going_on or open_ended:
                yield from self._in_parts(words, going_on, open_ended)
            else:
                for w in {w for w in words if w not in known}:
                    if known.found(w) is None:
                        known[w] = self._word(w)
                yield b"".join([known[w] for w in words])
            going_on = open_ended

    def _in_parts(self, words: list[str], going_on: bool, open_ended: bool) -> Iterator[bytes]:
        """Words of which the first goes on from the slice before or the last goes on in the next one."""
        for k, word in enumerate(words):
            parts = [x for x in self._specials.split(word) if x]
            for j, part in enumerate(parts):
                if part in self.special:
                    if k == j == 0 and going_on:
                        yield array("I", self.transducer.finish()).tobytes()
                    yield array("I", [self.special[part]]).tobytes()
                    continue
                pieces = self._split_word(part)
                for i, piece in enumerate(pieces):
                    for ids in self.transducer.feed([self.symbols[c] for c in piece]):
                        yield array("I", ids).tobytes()
                    if not (open_ended and k == len(words) - 1 and j == len(parts) - 1 and i == len(pieces) - 1):
                        yield array("I", self.transducer.finish()).tobytes()


class Decoder:
    """Reads ids and gives their text as far as it is settled.

    plain: the text that the tokens spell. Byte letters become bytes, a word's end a blank, and bytes
    become characters as soon as they are complete; what is no UTF-8 becomes U+FFFD. Otherwise the
    tokens as the tokenizers library joins those of a tokenizer without decoder: by blanks."""

    def __init__(self, tokens: dict[int, str], plain: bool = False):
        import codecs

        self.tokens, self.plain, self.begun = tokens, plain, False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")
        self.letters = {letter: b for b, letter in _byte_letters().items()} if plain else {}

    def feed(self, ids: Iterable[int]) -> str:
        words = list(filter(None, map(self.tokens.get, ids)))
        if not self.plain:
            text = " ".join(words)
            begun, self.begun = self.begun, self.begun or bool(words)
            return " " + text if begun and words else text
        return "".join(self._settled(w) for w in words)

    def _settled(self, token: str) -> str:
        body = token.removesuffix(ENDS)
        return self.bytes.decode(bytes(map(self.letters.__getitem__, body))) + (" " if body != token else "")

    def finish(self) -> str:
        return self.bytes.decode(b"", final=True)


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, str]]:
    for frame in frames:
        for i, t in zip(frame["doc_id"], frame["text"]):
            yield None if pd.isna(i) else int(i), t or ""


def encoded(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, row (a number of the input row), part (from 0), ids: each text's ids in parts of
    bounded length, of `part_tokens` and what one slice of the text adds. A null or empty text has one part without ids. Repeated rows are encoded each;
    other columns are ignored."""

    def run(frames):
        encode = StreamingEncoder.of(tokenizer_path)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def one(doc_id, row, part, ids):
            return pd.DataFrame({"doc_id": pd.array([doc_id], "Int64"), "row": [row], "part": [part], "ids": [list(ids)]})

        for row, (doc_id, text) in enumerate(_rows(frames), first):
            part, held = 0, array("I")
            for ids in encode(text):
                held.frombytes(ids)
                if len(held) >= part_tokens:
                    yield one(doc_id, row, part, held)
                    part, held = part + 1, array("I")
            if held or not part:
                yield one(doc_id, row, part, held)

    return only(documents, id_col, text_col).mapInPandas(run, "doc_id long, row long, part int, ids array<long>")


def decoded(parts: DataFrame, tokenizer_path: str, plain: bool = True) -> DataFrame:
    """doc_id, row, part, text of a table that encoded() made; texts of a row's parts, in order, are
    its text. Parts of a row pass one decoder, which carries characters that a part cuts over to
    the next."""

    def run(frames):
        tokens, machine, at = StreamingEncoder.of(tokenizer_path).tokens, None, None
        for frame in frames:
            out = []
            for doc_id, row, part, ids in zip(frame["doc_id"].astype("Int64"), frame["row"], frame["part"], frame["ids"]):
                if row != at:
                    machine, at = Decoder(tokens, plain), row
                out.append((doc_id, row, part, machine.feed(ids)))
            yield pd.DataFrame({c: [r[k] for r in out] for k, c in enumerate(("doc_id", "row", "part", "text"))})

    by_row = parts.select("doc_id", "row", "part", "ids").repartition("row").sortWithinPartitions("row", "part")
    return by_row.mapInPandas(run, "doc_id long, row long, part int, text string")


def streaming_round_trip(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit
    numbers) and decoded_sha256 (of the decoded text in UTF-8).

    Ids are encoded, decoded and digested part by part, so a task holds a text and a part of its
    ids. A null text is an empty one, without tokens. Repeated rows and null identifiers give rows
    of their own; an empty table gives an empty result; other columns are ignored."""

    def run(frames):
        encode = StreamingEncoder.of(tokenizer_path)
        for frame in frames:
            out = []
            for doc_id, text in _rows(iter([frame])):
                n, ids_digest, text_digest, machine = 0, hashlib.sha256(), hashlib.sha256(), Decoder(encode.tokens)
                for ids in encode(text):
                    n += len(ids) // 4
                    ids_digest.update(ids)
                    text_digest.update(machine.feed(array("I", ids)).encode())
                text_digest.update(machine.finish().encode())
                out.append((n, ids_digest.hexdigest(), text_digest.hexdigest()))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64")} | {c: [r[k] for r in out] for k, c in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))})

    return only(documents, id_col, text_col).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
