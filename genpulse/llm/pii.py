"""Personal data: base patterns, and a character-level BiLSTM-CRF for what they miss.

The patterns read whole texts in linear time. The tagger reads every window of the text that holds
a digit or an at sign, written or spelt "[at]"; its four kinds cannot be written without one, so
other windows have nothing to tag. Windows overlap by half. The spans that windows decode are
reconciled over the whole document: parts of one kind that overlap are joined, a span cut by its
window's edge counts less than one seen whole, and conflicts go to the surer and longer span. A
span stays only if its digits can be of its kind, and where it doesn't touch a base span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tagger
from .common import unused
from .tagger import KINDS, luhn

#: Columns that the operator gives.
FOUND = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans", "masked"]
#: Windows decoded at once; steps of the tagger's training.
DECODED, STRIDE = 2048, tagger.WINDOW // 2
_MARK = re.compile(r"[0-9@]|[\[({] ?at ?[\])}]", re.I)
_USER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the run of user characters before an at sign, and a domain with a dot.
    Looking from the at signs keeps long runs without one linear."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _USER:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        last = found.end() if found else at + 1
        if found:
            out.append((start, last))
        at = text.find("@", last)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind as KINDS lists them and then start."""
    out = [("email", *s) for s in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _plausible(kind: str, s: str) -> bool:
    d = _digits(s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d) and not re.search("[A-Za-z]", s)
    if kind == "phone":
        return 9 <= len(d) <= 15 and not re.search("[A-Za-z]", s) and bool(re.search(r"[+() .-]", s))
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?(?:@|[\[({] ?at ?[\])}])\s?[A-Za-z0-9-]+(?:\s?(?:\.|[\[({] ?dot ?[\])}])\s?[A-Za-z0-9-]+)+", s, re.I))
    if ":" in s:
        return bool(re.fullmatch(r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}", s))
    return bool(re.fullmatch(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}", s)) and all(int(p) <= 255 for p in s.split("."))


def _windows(text: str) -> list[int]:
    """Starts of the windows, on a grid of STRIDE, that hold a mark."""
    out, last = [], -1
    for m in _MARK.finditer(text):
        k = m.start() // STRIDE
        for j in (k - 1, k):
            if j > last and j >= 0:
                out.append(j * STRIDE)
                last = j
    return out


def _decoded(windows: list[np.ndarray], weights: dict) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, score) of the spans of each window."""
    x = np.zeros((tagger.WINDOW, len(windows)), dtype=np.int16)
    for k, w in enumerate(windows):
        x[: len(w), k] = w
    e = tagger.emissions(x, weights)
    tags = tagger.viterbi(e, weights)
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in windows]
    for k in np.flatnonzero(tags.any(0)).tolist():
        path, n, t = tags[:, k].tolist(), len(windows[k]), 0
        while t < n:
            if path[t] == 0:
                t += 1
                continue
            kind, start = (path[t] - 1) // 2, t
            t += 1
            while t < n and path[t] == 2 + 2 * kind:
                t += 1
            span = e[start:t, k]
            sure = span[:, 1 + 2 * kind : 3 + 2 * kind].max(1) - span[:, 0]
            out[k].append((kind, start, t, float(sure.mean())))
    return out


def reconcile(text: str, found: list[tuple[int, int, int, float]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The model's spans of one document, from those of all its windows: (kind, start, end, score)."""
    joined: list[list] = []
    for kind in range(len(KINDS)):
        for _, s, e, score in sorted(x for x in found if x[0] == kind):
            if joined and joined[-1][0] == kind and s < joined[-1][2]:
                joined[-1][2], joined[-1][3] = max(e, joined[-1][2]), max(score, joined[-1][3])
            else:
                joined.append([kind, s, e, score])
    taken, out = sorted((s, e) for _, s, e in base), []
    for kind, s, e, _ in sorted(joined, key=lambda x: (-x[3], x[1] - x[2], x[1])):
        while e > s and text[e - 1] in " \n.,;:":
            e -= 1
        while s < e and text[s] in " \n":
            s += 1
        if e > s and _plausible(KINDS[kind], text[s:e]) and all(e <= a or s >= b for a, b in taken):
            out.append((KINDS[kind], s, e))
            taken.append((s, e))
    return out


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def find_all(texts: list[str], weights: dict) -> list[tuple[list, list]]:
    """(base spans, spans of the model) of each text; windows of many texts are decoded together."""
    bases = [base_spans(t) if _MARK.search(t) else [] for t in texts]
    found: list[list] = [[] for _ in texts]
    queue: list[tuple[int, int, int, np.ndarray]] = []

    def flush() -> None:
        for (d, at, n, w), spans in zip(queue, _decoded([w for *_, w in queue], weights) if queue else []):
            for kind, s, e, score in spans:
                cut = (s == 0 and at > 0) or (e == len(w) and at + len(w) < n)
                found[d].append((kind, at + s, at + e, score * (0.5 if cut else 1.0)))
        queue.clear()

    for d, t in enumerate(texts):
        if not _MARK.search(t):
            continue
        for at in _windows(t):
            queue.append((d, at, len(t), tagger.codes(t[at : at + tagger.WINDOW])))
            if len(queue) >= DECODED:
                flush()
    flush()
    return [(b, reconcile(t, f, b)) for t, f, b in zip(texts, found, bases)]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in _ordered(spans))


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = tagger.STEPS) -> DataFrame:
    """documents with n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans (all, as
    kind:start:end in code points) and masked: the text with every span replaced by its kind.

    The new columns come first, and one of the same name in documents gives way. A null or empty
    text has no spans and is masked as itself. Repeated rows and null identifiers are rows of their
    own; an empty table gives an empty result.
    """
    given = {n: n for n in FOUND}
    return _with_spans(documents, text_col, given, [c for c in documents.columns if c.lower() not in given], steps)


def _with_spans(documents: DataFrame, text_col: str, given: dict[str, str], keep: list[str], steps: int) -> DataFrame:
    """The columns FOUND, under the names given, and then the columns `keep` of documents."""
    weights = tagger.trained(steps)
    rest = [documents.schema[c] for c in keep]
    schema = T.StructType([*[T.StructField(given[n], T.LongType() if n.startswith("n_") else T.StringType()) for n in FOUND], *rest])

    def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
        out, last = [], 0
        for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= last:
                out += [text[last:s], f"[{kind.upper()}]"]
            last = max(last, e)
        return "".join([*out, text[last:]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                found = find_all([t or "" for t in texts], weights)
                new = {f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS}
                new["base_sha256"] = pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found], pa.string())
                new["spans"] = pa.array([_listed(base + more) for base, more in found], pa.string())
                new["masked"] = pa.array([None if t is None else masked(t, base + more) for t, (base, more) in zip(texts, found)], pa.string())
                kept = {f.name: part.column(part.schema.get_field_index(f.name)) for f in rest}
                yield pa.RecordBatch.from_pydict({given[n]: new[n] for n in FOUND} | kept)

    return documents.mapInArrow(run, schema)


def mask(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """documents with personal data in text_col replaced by [EMAIL], [IP], [CARD] or [PHONE], and
    n_chars, where there is such a column, counted anew. All other columns stay as they are, whatever
    their names; null and empty texts stay, repeated rows and null identifiers are rows of their own."""
    given = {n: unused(documents, n) for n in FOUND}
    found = _with_spans(documents, text_col, given, documents.columns, tagger.STEPS)
    out = found.withColumn(text_col, F.col(given["masked"]))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(documents.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in documents.columns])
