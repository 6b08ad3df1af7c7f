"""Chat formatting: records of many layouts to canonical turns, and turns to one reversible template.

A record's layout is told from a fingerprint: the hash of its nested field paths, list positions
left out. The fingerprint selects a declarative mapping that says which fields hold which turns.
The template marks every turn with its role; control strings inside texts are escaped, so that
the formatted text reads back to the very turns it was made of.

Reading, mapping and escaping are row by row. Only a turn's place in its conversation needs the
others: turns are dealt by conversation, sorted, and passed through one at a time, so that a
conversation of any length takes no memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Layouts: the fields that must be there, those that may be, and where the turns are. `list`: one
#: turn per entry with role and text fields; `turns`: (role, fields whose texts are joined by a blank line).
LAYOUTS = {
    "turn": {"needs": ["role", "text"], "may": [], "list": None, "role": "role", "text": "text"},
    "messages": {"needs": ["messages[].role", "messages[].content"], "may": [], "list": "messages", "role": "role", "text": "content"},
    "conversations": {"needs": ["conversations[].from", "conversations[].value"], "may": [], "list": "conversations", "role": "from", "text": "value"},
    "dialogue": {"needs": ["dialogue[].speaker", "dialogue[].utterance"], "may": [], "list": "dialogue", "role": "speaker", "text": "utterance"},
    "instruction": {"needs": ["instruction", "output"], "may": ["input", "system"], "turns": [("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "prompt": {"needs": ["prompt", "response"], "may": ["system"], "turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    "completion": {"needs": ["prompt", "completion"], "may": ["system"], "turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])]},
    "question": {"needs": ["question", "answer"], "may": ["context"], "turns": [("user", ["context", "question"]), ("assistant", ["answer"])]},
    "nested": {"needs": ["data.messages[].role", "data.messages[].content"], "may": [], "list": "data.messages", "role": "role", "text": "content"},
}
#: Names of roles in records, and the canonical ones.
ROLES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "agent": "assistant"}
FIELDS = {path for layout in LAYOUTS.values() for path in [*layout["needs"], *layout["may"]]}

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this and of other common templates; each is escaped inside a text.
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPE = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROL))
_UNESCAPE = re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in CONTROL))
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
LOSS_ROLE = "assistant"


def paths(value, at: str = "") -> set[str]:
    """Field paths of a parsed record; entries of a list share one."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else k)} if value else {at}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} if value else {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    """Hash of the paths that any layout knows; others, such as identifiers and scores, don't count."""
    return hashlib.sha256("\n".join(sorted(found & FIELDS)).encode()).hexdigest()[:16]


def unread(turns: DataFrame) -> DataFrame:
    """fingerprint, n_records of the records in canonical_turns() that no layout fits; an empty
    fingerprint stands for what is no JSON."""
    return turns.where("layout IS NULL").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_records"))


def registry() -> dict[str, str]:
    """Layout by fingerprint, for every choice of its optional fields."""
    out = {}
    for name, layout in LAYOUTS.items():
        for k in range(len(layout["may"]) + 1):
            for some in combinations(layout["may"], k):
                out[fingerprint({*layout["needs"], *some})] = name
    return out


def _string(value) -> str:
    """A JSON value as text: null is empty, and half a surrogate pair, which no UTF-8 can hold, a replacement character."""
    text = value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)
    return text if text.isascii() else text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def turns_of(record: str | None, known: dict[str, str]) -> tuple[str, str | None, list[tuple[str, str]]]:
    """(fingerprint, layout, [(role, text)]) of one record of JSON."""
    try:
        value = json.loads(record or "")
        mark = fingerprint(paths(value))
    except (ValueError, RecursionError):  # no JSON, or nested too deep to be a conversation
        return "", None, []
    name = known.get(mark)
    if name is None:
        return mark, None, []
    layout = LAYOUTS[name]
    if "turns" in layout:
        out = []
        for role, fields in layout["turns"]:
            if any(f in value for f in fields):
                out.append((role, "\n\n".join(s for f in fields if (s := _string(value.get(f))))))
        return mark, name, out
    entries = [value]
    if layout["list"]:
        for key in layout["list"].split("."):
            value = value[key]
        entries = value
    renamed = ROLES if layout["list"] else {}  # single turns carry canonical roles already
    return mark, name, [(renamed.get(r := _string(e.get(layout["role"])), r), _string(e.get(layout["text"]))) for e in entries]


def canonical_turns(records: DataFrame, id_col: str, record_col: str, order_col: str | None = None) -> DataFrame:
    """conv_id, turn, part, role, text, fingerprint, layout: one row per turn of each JSON record.

    turn is order_col's value (null without it) and part a turn's place in its record. A record
    that is null, no JSON or of no known layout gives one row with null role, text and layout. A
    null role or text is the empty string. Repeated records give repeated turns.
    """
    order = records[order_col].cast("long") if order_col else F.lit(None).cast("long")
    rows = records.select(records[id_col].cast("long").alias("conv_id"), order.alias("turn"), records[record_col].alias("record"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = registry()
        for frame in frames:
            out = []
            for conv, turn, record in zip(frame["conv_id"], frame["turn"], frame["record"]):
                conv, turn = None if pd.isna(conv) else int(conv), None if pd.isna(turn) else int(turn)
                mark, name, found = turns_of(record, known)
                out += [(conv, turn, k, role, text, mark, name) for k, (role, text) in enumerate(found)] or [(conv, turn, 0, None, None, mark, name)]
            yield pd.DataFrame(out, columns=["conv_id", "turn", "part", "role", "text", "fingerprint", "layout"]).astype({"conv_id": "Int64", "turn": "Int64"})

    return rows.mapInPandas(run, "conv_id long, turn long, part int, role string, text string, fingerprint string, layout string")


def escape(text: str) -> str:
    """text with one more backslash in every control string, written out or escaped before."""
    return _ESCAPE.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text lies in it."""
    head, body = f"{START}{_escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation, or of some of its pieces."""
    return [(_unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, place, start, formatted, loss_start, loss_end of every turn of canonical_turns().

    A conversation is its rows' formatted strings one after another by place; start and the loss
    span count code points from the conversation's first. The loss span holds an assistant's
    escaped text, and is null for other roles. Turns go by turn, part, role and text, null turns
    first. Rows without layout aren't turns and are left out. Turns of a null conv_id form one
    conversation.
    """
    spoken = turns.where(F.col("layout").isNotNull()).select("conv_id", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = spoken.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, place, start = object(), 0, 0
        for frame in frames:
            out = []
            for conv, role, text in zip(frame["conv_id"], frame["role"], frame["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != last:
                    last, place, start = conv, 0, 0
                piece, a, b = format_turn(role, text)
                loss = (start + a, start + b) if role == LOSS_ROLE else (None, None)
                out.append((conv, place, start, piece, *loss))
                place, start = place + 1, start + len(piece)
            yield pd.DataFrame(out, columns=["conv_id", "place", "start", "formatted", "loss_start", "loss_end"]).astype({"conv_id": "Int64", "place": "int64", "start": "int64", "loss_start": "Int64", "loss_end": "Int64"})

    return dealt.mapInPandas(run, "conv_id long, place long, start long, formatted string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation,
    from format_conversations(), read from the strings and loss spans alone. The rows must come
    dealt and sorted as format_conversations() leaves them; they are digested as they pass."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: list = []

        def ended() -> list[tuple]:
            return [(state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])] if state else []

        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for frame in frames:
            out = []
            for conv, start, piece, a, b in zip(frame["conv_id"], frame["start"], frame["formatted"], frame["loss_start"], frame["loss_end"]):
                conv = None if pd.isna(conv) else int(conv)
                if not state or state[0] != conv:
                    out += ended()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                if not pd.isna(a):
                    loss = unescape(piece[int(a) - int(start) : int(b) - int(start)])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "replace"))
                state[5] += len(piece)
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
        yield pd.DataFrame(ended(), columns=columns).astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
