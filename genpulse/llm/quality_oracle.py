"""The quality operator's result as DuckDB SQL: the same counts, votes and steps."""

from __future__ import annotations

from . import quality_rules as q


def _start_rates() -> str:
    return ", ".join(f"{q.START[vote][0]!r} AS {name}_bad, {q.START[vote][1]!r} AS {name}_good" for name, vote, _ in q.RULES)


def _log_odds() -> str:
    terms = ["ln(prior / (1 - prior))"]
    terms += [f"CASE WHEN votes_{n} THEN ln({n}_good / {n}_bad) ELSE ln((1 - {n}_good) / (1 - {n}_bad)) END" for n, _, _ in q.RULES]
    return " + ".join(terms)


def _step_rates() -> str:
    out = []
    for name, vote, _ in q.RULES:
        on_bad, on_good = q.START[vote]
        out.append(f"(coalesce(sum(n - good) FILTER (votes_{name}), 0) + {q.BELIEF!r} * sum(n) * {on_bad!r}) / (sum(n) - sum(good) + {q.BELIEF!r} * sum(n))")
        out.append(f"(coalesce(sum(good) FILTER (votes_{name}), 0) + {q.BELIEF!r} * sum(n) * {on_good!r}) / (sum(good) + {q.BELIEF!r} * sum(n))")
    return ", ".join(out)


def counts_sql(source: str = "documents") -> str:
    """CTEs that end in `counted`: doc_id and the counts of every row of source."""
    return rf"""
split_up AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT doc_id, list_sort(list_transform(range(1, len(words) - 1), lambda i: {{'g': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2], 'i': i}})) AS s
    FROM split_up WHERE len(words) >= 3),
places AS (
    SELECT doc_id, list_sort(list_transform(list_filter(range(1, len(s) + 1), lambda k: (k > 1 AND s[k].g = s[k - 1].g) OR (k < len(s) AND s[k].g = s[k + 1].g)), lambda k: s[k].i)) AS places_at
    FROM windows),
covered AS (
    SELECT doc_id, coalesce(list_sum(list_transform(range(1, len(places_at) + 1), lambda k: CASE WHEN k = len(places_at) THEN 3 ELSE least(3, places_at[k + 1] - places_at[k]) END)), 0) AS n
    FROM places),
counted AS (
    SELECT doc_id,
           len(words) AS n_words,
           length(array_to_string(words, '')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
           len(lines) AS n_lines,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
           len(list_distinct(words)) AS n_distinct_words,
           length(t) - length(replace(t, '!', '')) AS n_exclaims
    FROM split_up LEFT JOIN covered c USING (doc_id))""".replace("FROM documents),", f"FROM {source}),", 1)


def judged_sql(source: str = "documents") -> str:
    """CTEs that end in `judged`: the counts, base_failed and kept."""
    flags = ", ".join(f"coalesce({condition}, false) AS votes_{name}" for name, _, condition in q.RULES)
    return f"""{counts_sql(source)},
voted AS (SELECT *, {flags} FROM counted),
patterns AS (SELECT {", ".join(f"votes_{n}" for n, _, _ in q.RULES)}, count(*) AS n FROM voted GROUP BY ALL),
em AS (
    SELECT 0 AS step, {q.START_GOOD!r}::DOUBLE AS prior, {_start_rates()}
    UNION ALL
    SELECT step + 1, (sum(good) + {q.BELIEF!r} * sum(n) * {q.START_GOOD!r}) / (sum(n) + {q.BELIEF!r} * sum(n)), {_step_rates()}
    FROM (SELECT *, n / (1 + exp(-({_log_odds()}))) AS good FROM patterns, em WHERE step < {q.ITERATIONS})
    GROUP BY step),
judged AS (
    SELECT voted.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 1 / (1 + exp(-({_log_odds()}))) >= {q.THRESHOLD!r} AS kept
    FROM voted, (SELECT * FROM em ORDER BY step DESC LIMIT 1))"""


OP2_SQL = f"WITH RECURSIVE {judged_sql()}\nSELECT doc_id, {', '.join(q.COUNTS)}, base_failed, kept FROM judged"
