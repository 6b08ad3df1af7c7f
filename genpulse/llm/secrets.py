"""Secret scans with multipart credential linking.

Patterns that are secret by themselves are reported as they stand. Weak candidates - a user name,
a loose random string, an endpoint - mean nothing alone; each is reported only where a
complementary part lies within `reach` characters in the same document: an identifier and a
secret, or an endpoint and a secret. The parts meet in an interval join on (document, stretch of
text). Before it, every stretch is reduced to the outermost ends of its parts, so a stretch is one
row however many candidates it holds, and no pairs within a group are formed.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, stored

REACH = 200
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Weak parts: identifiers of an account, loose random strings, endpoints.
NAMED = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9][A-Za-z0-9_.@-]{2,}+)""", re.I | re.A)
LOOSE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
ENDPOINT = re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ssh)://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]{3,}+", re.A)
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_NAMED_WORD = re.compile(r"user|login|account|client|access", re.I | re.A)
#: Bits a character that a loose string carries at least, and the kinds of character it mixes.
ENTROPY = 3.5

WEAK = ("identifier", "endpoint", "secret")
FOUND = "doc_id long, row long, kinds array<string>, firsts array<int>, lasts array<int>"


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns, by start and then kind as KINDS lists them."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def weak_parts(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, part) of candidates that count only beside a complementary part, clear of base spans."""
    found = []
    if _NAMED_WORD.search(text):
        found += [(m.start(), m.end(), "identifier") for m in NAMED.finditer(text)]
    if "://" in text:
        found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    for m in LOOSE.finditer(text):
        s = m[0]
        if re.search("[0-9]", s) and re.search("[a-z]", s) and re.search("[A-Z]", s) and _entropy(s) >= ENTROPY:
            found.append((m.start(), m.end(), "secret"))
    # a value within an endpoint is a part of its own, and the endpoint ends before it
    values = [s for s, _, part in found if part == "identifier" or part == "secret" and text[s] != "/" and text[max(0, s - 1) : s] in ("=", ":")]
    values.sort()
    for k, (s, e, part) in enumerate(found):
        if part == "endpoint" and (v := bisect_right(values, s)) < len(values) and values[v] < e:
            found[k] = (s, values[v], part)
    taken, out, b = sorted(base), [], 0
    reached = -1
    for s, e, part in sorted(found):
        while b < len(taken) and taken[b][0] < e:
            reached = max(reached, taken[b][1])
            b += 1
        if s >= reached:
            out.append((s, e, part))
            reached = e
    return out


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    row = TaskContext.get().partitionId() << 33
    for frame in frames:
        rows = []
        for i, t in zip(frame["doc_id"], frame["text"]):
            base = base_spans(t) if t else []
            spans = base + weak_parts(t, base) if t else []
            rows.append((None if pd.isna(i) else int(i), row, [k for _, _, k in spans], [s for s, _, _ in spans], [e for _, e, _ in spans]))
            row += 1
        yield pd.DataFrame(rows, columns=["doc_id", "row", "kinds", "firsts", "lasts"]).astype({"doc_id": "Int64", "row": "int64"})


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak ones of parts (row, kind, first, last) with a complementary part of the same row
    at most reach characters away.

    A part belongs to every stretch of reach characters that it touches, and what is near a
    candidate lies in the candidate's stretches or those beside them. Of the parts of one sort in
    a stretch after the candidate, the one that begins first decides, and of those in a stretch
    before it, the one that ends last; so a stretch is aggregated before the join, and nothing
    is lost by it.
    """
    sort = F.when(F.col("kind") == "access", "identifier").when(F.col("kind").isin("assign", "hex"), "secret").otherwise(F.col("kind"))
    parts = parts.withColumn("part", sort)
    touched = F.explode(F.sequence(F.floor(F.col("first") / reach), F.floor((F.col("last") - 1) / reach)))
    ends = (
        parts.select("row", "part", "first", "last", touched.alias("stretch"))
        .groupBy("row", "stretch", "part")
        .agg(F.min("first").alias("least_first"), F.max("last").alias("most_last"))
    )
    needs = F.when(F.col("part") == "secret", F.array(F.lit("identifier"), F.lit("endpoint"))).otherwise(F.array(F.lit("secret")))
    beside = F.explode(F.sequence(F.floor(F.col("first") / reach) - 1, F.floor((F.col("last") - 1) / reach) + 1))
    asks = (
        parts.where(F.col("kind").isin(*WEAK))
        .select("row", "kind", "first", "last", F.explode(needs).alias("part"))
        .select("*", beside.alias("stretch"))
    )
    near = (F.col("least_first") <= F.col("last") + reach) & (F.col("most_last") >= F.col("first") - reach)
    return asks.join(ends, ["row", "stretch", "part"]).where(near).select("row", "kind", "first", "last").distinct()


def find_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    spans: kind:start:end of all findings by start, then base kinds as listed, then linked kinds,
    in code points with exclusive end. Null and empty texts have none; repeated rows and null
    identifiers are rows of their own; an empty table gives an empty result.
    """
    scanned = stored(only(documents, id_col, text_col).mapInPandas(_scan, FOUND), "secret-parts")
    zipped = F.arrays_zip("kinds", "firsts", "lasts")
    has_weak = F.arrays_overlap("kinds", F.array(*map(F.lit, WEAK)))
    parts = scanned.where(has_weak).select("row", F.explode(zipped).alias("p")).select("row", F.col("p.kinds").alias("kind"), F.col("p.firsts").alias("first"), F.col("p.lasts").alias("last"))

    def ordered(kind, first, last):
        place = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in enumerate(KINDS) for x in (v, k)]), kind), F.lit(len(KINDS)))
        return F.struct(first.alias("first"), place.alias("place"), last.alias("last"), F.concat_ws(":", kind, first, last).alias("span"))

    more = linked(parts, reach).groupBy("row").agg(F.collect_list(ordered(F.col("kind"), F.col("first"), F.col("last"))).alias("more"))
    base = F.transform(F.filter(zipped, lambda x: x["kinds"].isin(*KINDS)), lambda x: ordered(x["kinds"], x["firsts"], x["lasts"]))
    both = scanned.withColumn("base", base).join(more, "row", "left").withColumn("more", F.coalesce("more", F.filter("base", lambda x: F.lit(False))))

    def listed(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda x: x["span"]), ",")

    def counted(kind):
        return F.size(F.filter("kinds", lambda x: x == kind)).cast("long")

    return both.select(
        "doc_id",
        *[counted(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_linked"),
    )
