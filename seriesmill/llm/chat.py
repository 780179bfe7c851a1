"""Chat records of any known layout to canonical turns and a reversible template.

A record is a JSON text.  Its nested field paths (arrays as []), reduced to those some mapping
uses, are sorted and hashed; the hash selects a declarative mapping that says which paths hold
roles and texts.  Turns are written as segments of one text per conversation:

    ### Assistant: text </turn>

Inside roles and texts, backslashes, runs of three or more # and the string </turn> are
escaped with backslashes, so a reader that takes tokens from the left finds the very turns
that were written.  The text of assistant turns is the loss mask.

Defined results
    null texts and roles count as empty; text that is no JSON object or nests more than
    ``DEPTH`` times, or whose fields fit no mapping, is reported with status `malformed` or `unknown`
    and no turns; half of a surrogate pair (an escape in JSON) becomes U+FFFD; empty optional
    parts give no turn; turns of a conversation are ordered by the order column (nulls
    first), then their place in the record, role and text, so repeated rows stay repeated;
    fields and columns no mapping names are ignored; an empty table gives no conversation.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Most objects and arrays within each other.
DEPTH = 100
_HALF = re.compile("[\ud800-\udfff]")

# --- layouts ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """``parts`` are (role, path) pairs in order; a role starting with $ names the path of the role.

    Paths ending in [] fields give one turn per element.  ``optional`` paths may be missing.
    """

    name: str
    parts: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        return {p for _, p in self.parts} | {r[1:] for r, _ in self.parts if r.startswith("$")}


#: Field names of the layouts in use and the roles they stand for.
MAPPINGS = (
    Mapping("turn", (("$role", "text"),)),
    Mapping("turn_content", (("$role", "content"),)),
    Mapping("messages", (("$messages[].role", "messages[].content"),)),
    Mapping("messages_text", (("$messages[].role", "messages[].text"),)),
    Mapping("conversations", (("$conversations[].from", "conversations[].value"),),
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Mapping("prompt_response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), ("system",)),
    Mapping("question_answer", (("system", "system"), ("user", "question"), ("assistant", "answer")), ("system",)),
    Mapping("instruction", (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
            ("system", "input")),
)
KNOWN = frozenset().union(*(m.paths() for m in MAPPINGS))


def field_paths(value, at: str = "") -> set[str]:
    """Paths of all values below ``value`` that are no object or array."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(field_paths(v, at + "[]") for v in value)) if value else set()
    return {at}


def fingerprint(paths) -> str:
    """Hash of the known paths, in order."""
    return hashlib.sha256("\n".join(sorted(KNOWN.intersection(paths))).encode()).hexdigest()[:16]


def _table() -> dict[str, Mapping]:
    out = {}
    for m in MAPPINGS:
        for n in range(len(m.optional) + 1):
            for left in combinations(m.optional, n):
                out.setdefault(fingerprint(m.paths() - set(left)), m)
    return out


SELECT = _table()


def _values(value, path: str) -> list:
    """What stands at a path: one value, or one per element of its array."""
    head, _, rest = path.partition("[].")
    for key in head.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    if not rest:
        return [value]
    return [v for element in (value or []) for v in _values(element, rest)]


def _text(value) -> str:
    """A value as text; half of a surrogate pair, which no UTF-8 text can hold, becomes U+FFFD."""
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return _HALF.sub("\ufffd", text)


def _deep(value, most: int = DEPTH) -> bool:
    """Whether objects and arrays lie in each other more than ``most`` times."""
    open_ = [(value, 1)]
    while open_:
        now, depth = open_.pop()
        if isinstance(now, (dict, list)):
            if depth > most:
                return True
            open_ += [(v, depth + 1) for v in (now.values() if isinstance(now, dict) else now)]
    return False


def canonical(record: str | None) -> tuple[str, str, list[tuple[str, str]]]:
    """(schema fingerprint, mapping name or status, turns) of one record."""
    try:
        value = json.loads(record or "")
    except (ValueError, RecursionError):
        value = None
    if not isinstance(value, dict) or _deep(value):
        return "", "malformed", []
    mark = fingerprint(field_paths(value))
    mapping = SELECT.get(mark)
    if mapping is None:
        return mark, "unknown", []
    names, turns = dict(mapping.roles), []
    for role, path in mapping.parts:
        texts = _values(value, path)
        if role.startswith("$"):
            turns += [(names.get(r, r), t) for r, t in zip(map(_text, _values(value, role[1:])), map(_text, texts))]
        elif texts[0] not in (None, "") or path not in mapping.optional:
            turns.append((role, _text(texts[0])))
    return mark, mapping.name, turns


# --- template ---------------------------------------------------------------------------

_SPECIAL = re.compile(r"\\|#{3,}|</turn>")
_SPECIAL_IN_ROLE = re.compile(r"\\|#{3,}|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|#|:|</turn>)")
_ROLE_END = re.compile(r"\\(?:\\|#|:|</turn>)|(: )")
_TURN_END = re.compile(r"\\(?:\\|#|</turn>)|( </turn>\n)")


def escape(text: str, special: re.Pattern = _SPECIAL) -> str:
    return special.sub(lambda m: "".join("\\" + c for c in m[0]) if m[0][0] == "#" else "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The written turn and where its escaped text begins and ends."""
    head, body = f"### {escape(role, _SPECIAL_IN_ROLE)}: ", escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def _next(pattern: re.Pattern, text: str, at: int) -> re.Match:
    """The first unescaped match; escapes are stepped over from the left."""
    for found in pattern.finditer(text, at):
        if found[1]:
            return found
    raise ValueError(f"turn at {at} has no end")


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of formatted text."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith("### ", at):
            raise ValueError(f"no turn at {at}")
        colon = _next(_ROLE_END, text, at + 4)
        end = _next(_TURN_END, text, colon.end())
        turns.append((unescape(text[at + 4:colon.start()]), unescape(text[colon.end():end.start()])))
        at = end.end()
    return turns


# --- tables -----------------------------------------------------------------------------

def turns(records: DataFrame, conv_id: str, order: str, record: str) -> DataFrame:
    """One row per turn: ``conv_id, at, place, role, text``, and one without role for a record that has none.

    ``schema`` is the fingerprint and ``layout`` the mapping or status of the record.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, at, value in zip(batch["conv_id"], batch["at"], batch["record"]):
                mark, layout, found = canonical(value)
                rows += [(key, at, k, r, t, mark, layout) for k, (r, t) in enumerate(found or [(None, None)])]
            out = pd.DataFrame(rows, columns=["conv_id", "at", "place", "role", "text", "schema", "layout"])
            yield out.astype({"conv_id": "Int64", "at": "Int64"})

    return records.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(order).cast("bigint").alias("at"),
                          F.col(record).cast("string").alias("record")).mapInPandas(
        run, "conv_id bigint, at bigint, place int, role string, text string, schema string, layout string")


def formatted(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` text and ``loss``, the spans [begin, end) of assistant texts.

    A conversation is one training text; its turns meet in the row that becomes this text.
    """
    ordered = rows.where("role is not null").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "place", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, found in zip(batch["conv_id"], batch["turns"]):
                parts, spans, size = [], [], 0
                for turn in found:
                    written, begin, end = segment(turn["role"], turn["text"])
                    if turn["role"] == "assistant":
                        spans.append({"begin": size + begin, "end": size + end})
                    parts.append(written)
                    size += len(written)
                rows.append((key, "".join(parts), spans))
            yield pd.DataFrame(rows, columns=["conv_id", "formatted", "loss"]).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(run, "conv_id bigint, formatted string, loss array<struct<begin: bigint, end: bigint>>")


def digests(texts: DataFrame) -> DataFrame:
    """What a reader finds in formatted texts: turns, their digest, and the digest of all text under the mask."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss"]):
                read = parse(text)
                all_turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in read).encode()).hexdigest()
                masked = "".join(unescape(text[s["begin"]:s["end"]]) for s in spans)
                rows.append((key, len(read), all_turns, len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in fields]).astype({"conv_id": "Int64"})

    fields = ["conv_id bigint", "n_turns bigint", "turns_sha256 string", "loss_chars bigint", "loss_sha256 string",
              "formatted_chars bigint"]
    return texts.mapInPandas(run, ", ".join(fields))
