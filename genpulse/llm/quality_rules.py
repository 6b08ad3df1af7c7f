"""Document quality by weak supervision.

Rules look at counts of one document and vote or abstain: some know what is bad, some what is
good. Nobody says how far each rule is to be trusted: expectation-maximisation estimates how often
each votes on good and on bad documents, and the posterior probability that a document is good replaces a
filter which all rules must pass. An abstention counts too: as often as it happens on each kind.

The votes of a document are one of 2**rules patterns, so the iterations run over a table of
patterns with their counts, whose size doesn't depend on the corpus, and each iteration is one
DataFrame aggregate whose single row holds the parameters. Counts cover all documents.
Everything here is DataFrame functions; no text leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, only, stored, without_rejected

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Each rule: name, vote, SQL condition of the vote over the counts; otherwise it abstains.
#: Integers only, so that every engine takes the same votes.
RULES = [
    ("symbols", -1, "10 * n_symbols > n_words"),
    ("repeats", -1, "100 * n_repeat_words > 40 * n_words"),
    ("dup_lines", -1, "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    ("word_length", -1, "word_chars > 11 * n_words OR word_chars < 3 * n_words"),
    ("capitals", -1, "10 * n_capitals > 3 * word_chars"),
    ("vocabulary", -1, "n_words >= 50 AND 10 * n_distinct_words < n_words"),
    ("exclaims", -1, "5 * n_exclaims > n_words"),
    ("prose", 1, "n_words >= 20 AND 20 * n_symbols <= n_words AND 20 * n_exclaims <= n_words AND 5 * n_capitals <= word_chars AND 20 * n_repeat_words <= 7 * n_words"),
]

#: Before the first step: how often a rule votes on bad and on good documents, by the direction of
#: its vote, and the share of good documents. Share of all documents that this belief is worth.
START, START_GOOD, BELIEF = {-1: (0.3, 0.02), 1: (0.3, 0.9)}, 0.8, 0.05
ITERATIONS = 20
#: Least posterior of a kept document.
THRESHOLD = 0.5


def text_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_capitals, n_distinct_words and n_exclaims (long) of every whole text; a null text has none.

    Windows of three words that occur again are found by sorting a document's windows, so that
    equal ones are neighbours: a text of n words takes n log n steps, however repetitive it is.
    Windows are compared by 64-bit hashes within one document.
    """
    documents, text = only(documents, id_col, text_col), F.coalesce("text", F.lit(""))
    words = F.expr(f"filter(split(_text, r'{SEPARATORS}'), x -> x <> '')")
    windows = F.expr("transform(sequence(0, size(_words) - 3), i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS g, i AS i))")
    windows = F.when(F.size("_words") >= 3, windows)
    again = F.expr("transform(filter(transform(_sorted, (x, k) -> struct(x.i AS i, (k > 0 and x.g = _sorted[k - 1].g) or (k + 1 < size(_sorted) and x.g = _sorted[k + 1].g) AS twice)), y -> y.twice), y -> y.i)")
    covered = F.expr("aggregate(_at, struct(cast(-3 AS int) AS last, 0L AS n), (s, p) -> struct(p AS last, s.n + least(3, p - s.last) AS n), s -> s.n)")
    lines = F.expr(r"filter(split(_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')")

    def long(x: Column) -> Column:
        return x.cast("long")

    with_words = documents.withColumn("_text", text).withColumn("_words", words)
    with_windows = with_words.withColumn("_sorted", F.sort_array(windows))
    with_places = with_windows.withColumn("_at", F.sort_array(again)).withColumn("_lines", lines)
    out = with_places.withColumns(
        {
            "n_words": long(F.size("_words")),
            "word_chars": long(F.length(F.array_join("_words", ""))),
            "n_symbols": long(F.regexp_count("_text", F.lit(f"[{SYMBOLS}]"))),
            "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "n_repeat_words": long(F.coalesce(covered, F.lit(0))),
            "n_lines": long(F.size("_lines")),
            "n_capitals": long(F.regexp_count("_text", F.lit("[A-Z]"))),
            "n_distinct_words": long(F.size(F.array_distinct("_words"))),
            "n_exclaims": long(F.regexp_count("_text", F.lit("!"))),
        }
    )
    return out.drop("text", "_text", "_words", "_sorted", "_at", "_lines")


def votes(counted: DataFrame) -> DataFrame:
    """counted with one boolean column votes_<rule> for each rule; false: the rule abstains."""
    return counted.withColumns({f"votes_{name}": F.coalesce(F.expr(condition), F.lit(False)) for name, _, condition in RULES})


def log_odds_sql(model: dict) -> str:
    """ln(P(good | votes) / P(bad | votes)) as SQL, over the columns of votes()."""
    terms = [repr(math.log(model["prior"] / (1 - model["prior"])))]
    for name, (bad, good) in model["rates"].items():
        terms.append(f"CASE WHEN votes_{name} THEN {math.log(good / bad)!r}D ELSE {math.log((1 - good) / (1 - bad))!r}D END")
    return " + ".join(terms)


def _posterior(model: dict) -> Column:
    return 1 / (1 + F.exp(-F.expr(log_odds_sql(model))))


def fit(voted: DataFrame, iterations: int = ITERATIONS) -> dict:
    """How often each rule votes on bad and on good documents, learnt from votes alone:
    {"prior": P(good), "rates": {rule: (on bad, on good)}}. An empty table leaves the start values."""
    names = [name for name, _, _ in RULES]
    patterns = stored(voted.groupBy(*[f"votes_{n}" for n in names]).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    model = {"prior": START_GOOD, "rates": {name: START[vote] for name, vote, _ in RULES}}
    for _ in range(iterations):
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
        for name in names:
            here = F.col(f"votes_{name}")
            sums += [F.sum(F.when(here, F.col("n"))).alias(name), F.sum(F.when(here, F.col("good"))).alias(f"{name}_good")]
        s = {k: v or 0 for k, v in patterns.withColumn("good", F.col("n") * _posterior(model)).agg(*sums).first().asDict().items()}
        if not s["n"]:
            break
        belief = BELIEF * s["n"]
        rates = {}
        for name, vote, _ in RULES:
            on_bad, on_good = START[vote]
            bad = (s[name] - s[f"{name}_good"] + belief * on_bad) / (s["n"] - s["good"] + belief)
            good = (s[f"{name}_good"] + belief * on_good) / (s["good"] + belief)
            rates[name] = (bad, good)
        model = {"prior": (s["good"] + belief * START_GOOD) / (s["n"] + belief), "rates": rates}
    return model


def quality(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", iterations: int = ITERATIONS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, the counts of text_counts, votes, base_failed, quality, kept.

    base_failed: fewer than 50 words, or over half of them in windows of three words that the
    document repeats. quality: posterior probability that the document is good. kept: not
    base_failed and quality of at least threshold. Null and empty texts have no words and fail;
    repeated rows get the same verdict each; an empty table gives an empty result.
    """
    counted = text_counts(documents, id_col, text_col)
    voted = stored(votes(counted), "votes")
    model = fit(voted, iterations)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = voted.withColumns({"base_failed": failed, "quality": _posterior(model)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def good_documents(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that quality keeps, with all their columns."""
    # a verdict hangs on the text alone, so its hash is the key of repeated and null identifiers too
    rows = carried(documents, text_col, text_col).withColumn("key", F.xxhash64("text"))
    judged = quality(rows, "key").withColumnRenamed("doc_id", "key")
    return without_rejected(rows, judged, ["key"])
