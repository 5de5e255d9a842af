"""Chat records of many layouts, turned into canonical turns and formatted text.

The nested field paths of a record, sorted and hashed, are its schema fingerprint;
paths that only some elements of a list have are marked in it.  A fingerprint selects one
declarative mapping: the first in LAYOUTS whose fields are all there, in all elements.  The mapping says where the turns, their roles and texts are; no
layout has code of its own.  Turns are written with a template whose control
strings cannot occur inside a text, because those that do are escaped, reversibly.

Defined results.  A null text or role counts as empty.  Turns come in order of turn
number (null first), those of one number in order of their formatted text; equal
rows are turns of their own.  A
record that is null, no JSON object, nested too deeply to be parsed, or of no known
layout has no turns and the layout null.  A list whose elements are of different known
shapes, bare strings among them, is read element by element, if all are known.  A dot in
a field's name is part of the name, and half of a surrogate pair becomes U+FFFD.  Rows with a null id form one conversation.  Columns other than those
named are ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir

ROLE_NAMES = {
    "human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant",
    "model": "assistant", "chatbot": "assistant", "ai": "assistant",
}


@dataclass(frozen=True)
class Each:
    """One turn per element of a list; a bare string if ``text`` is empty, its role
    then alternating through ``roles``.  With ``parts``, ``text`` is a list whose elements have
    pieces of the text in that field."""

    items: str
    role: str = ""
    text: str = ""
    roles: tuple[str, ...] = ("user", "assistant")
    parts: str = ""

    @property
    def needs(self) -> tuple[str, ...]:
        text = f"{self.text}[].{self.parts}" if self.parts else self.text
        return tuple(f"{self.items}[].{p}" for p in (self.role, text) if p) or (f"{self.items}[]",)


@dataclass(frozen=True)
class Take:
    """One turn from one or more fields, joined by an empty line; fields after the
    first may be absent or empty.  With ``role_from``, the role is in a field, as it is."""

    fields: tuple[str, ...]
    role: str = ""
    role_from: str = ""
    optional: bool = False

    @property
    def needs(self) -> tuple[str, ...]:
        return () if self.optional else tuple(p for p in (self.fields[0], self.role_from) if p)


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Each | Take, ...]

    @property
    def needs(self) -> frozenset[str]:
        return frozenset(p for t in self.turns for p in t.needs)


SYSTEM = Take(("system",), "system", optional=True)

#: In order: the first layout whose fields a record has is the one used.
LAYOUTS = (
    Layout("messages", (SYSTEM, Each("messages", "role", "content"))),
    Layout("messages_parts", (SYSTEM, Each("messages", "role", "content", parts="text"))),
    Layout("messages_from", (SYSTEM, Each("messages", "from", "value"))),
    Layout("conversations_from", (SYSTEM, Each("conversations", "from", "value"))),
    Layout("conversations_role", (SYSTEM, Each("conversations", "role", "content"))),
    Layout("conversation_role", (SYSTEM, Each("conversation", "role", "content"))),
    Layout("conversation_pairs", (SYSTEM, Each("conversation", "speaker", "text"))),
    Layout("turns", (SYSTEM, Each("turns", "role", "text"))),
    Layout("dialog_role", (SYSTEM, Each("dialog", "role", "content"))),
    Layout("nested_messages", (Each("data.messages", "role", "content"),)),
    Layout("author_parts", (Each("messages", "author.role", "content.text"),)),
    Layout("dialog_strings", (SYSTEM, Each("dialog"))),
    Layout("conversation_strings", (SYSTEM, Each("conversation"))),
    Layout("instruction", (SYSTEM, Take(("instruction", "input"), "user"), Take(("output",), "assistant"))),
    Layout("instruction_response", (
        SYSTEM, Take(("instruction", "context"), "user"), Take(("response",), "assistant"))),
    Layout("instruction_completion", (SYSTEM, Take(("instruction",), "user"), Take(("completion",), "assistant"))),
    Layout("prompt_messages", (Each("prompt", "role", "content"), Take(("completion",), "assistant"))),
    Layout("prompt_completion", (SYSTEM, Take(("prompt",), "user"), Take(("completion",), "assistant"))),
    Layout("prompt_response", (SYSTEM, Take(("prompt",), "user"), Take(("response",), "assistant"))),
    Layout("prompt_chosen", (SYSTEM, Take(("prompt",), "user"), Take(("chosen",), "assistant"))),
    Layout("question_answer", (SYSTEM, Take(("question", "context"), "user"), Take(("answer",), "assistant"))),
    Layout("query_response", (SYSTEM, Take(("query",), "user"), Take(("response",), "assistant"))),
    Layout("inputs_targets", (Take(("inputs",), "user"), Take(("targets",), "assistant"))),
    Layout("user_assistant", (SYSTEM, Take(("user",), "user"), Take(("assistant",), "assistant"))),
    Layout("turn_row", (Take(("text",), role_from="role"),)),
    Layout("message_row", (Take(("content",), role_from="role"),)),
)

#: Lists whose elements may be of different shapes, and the role and text of each shape.
MIXED_LISTS = ("messages", "conversations", "conversation", "dialog", "turns")
ELEMENTS = (("role", "content"), ("from", "value"), ("speaker", "text"), ("role", "text"), ("author.role", "content.text"))


def field_paths(value, prefix: str = "") -> Iterator[str]:
    """Paths of a parsed record down to its leaves; ``[]`` stands for any element."""
    if isinstance(value, dict) and value:
        for name, inner in value.items():
            name = name.replace("\\", "\\\\").replace(".", "\\.")
            yield from field_paths(inner, f"{prefix}.{name}" if prefix else name)
    elif isinstance(value, list) and value:
        for inner in value:
            yield from field_paths(inner, f"{prefix}[]")
    else:
        yield f"{prefix}[]" if isinstance(value, list) else prefix


def partial_paths(value, prefix: str = "") -> Iterator[str]:
    """Paths below a list that only some of its elements have, each with a mark."""
    if isinstance(value, dict):
        for name, inner in value.items():
            name = name.replace("\\", "\\\\").replace(".", "\\.")
            yield from partial_paths(inner, f"{prefix}.{name}" if prefix else name)
    elif isinstance(value, list):
        own = [set(field_paths(inner, f"{prefix}[]")) for inner in value]
        yield from (f"{p}?" for p in sorted(set().union(*own)) if not all(p in o for o in own))
        for inner in value:
            yield from partial_paths(inner, f"{prefix}[]")


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode(errors="surrogatepass")).hexdigest()[:16]


def choose(paths) -> Layout | None:
    have = set(paths)
    return next(
        (layout for layout in LAYOUTS if layout.needs <= have and not any(f"{p}?" in have for p in layout.needs)), None
    )


def mixed_turns(record: dict) -> tuple[str, list[tuple[str, str]]] | None:
    """Name and turns of a list whose elements are each of some known shape."""
    for name in MIXED_LISTS:
        items = record.get(name)
        if not isinstance(items, list) or not items:
            continue
        made = []
        for i, item in enumerate(items):
            if isinstance(item, str):
                made.append((("user", "assistant")[i % 2], item))
                continue
            fits = ((_at(item, r), _at(item, t)) for r, t in ELEMENTS if _has(item, r) and _has(item, t))
            if (found := next(fits, None)) is None:
                break
            role = _text(found[0])
            made.append((ROLE_NAMES.get(role.lower(), role), _text(found[1])))
        else:
            return f"{name}_mixed", made
    return None


def _has(value, path: str) -> bool:
    for name in path.split("."):
        if not isinstance(value, dict) or name not in value:
            return False
        value = value[name]
    return True


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None or isinstance(value, str):
        return value or ""
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def _whole(text: str) -> str:
    """``text`` with halves of surrogate pairs replaced, which UTF-8 cannot hold."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def apply_layout(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """``(role, text)`` of the record's turns."""
    made = []
    for turn in layout.turns:
        if isinstance(turn, Each):
            for i, item in enumerate(_at(record, turn.items) or ()):
                role = _text(_at(item, turn.role)) if turn.role else turn.roles[i % len(turn.roles)]
                text = _at(item, turn.text) if turn.text else item
                text = "".join(_text(_at(p, turn.parts)) for p in text) if turn.parts else _text(text)
                made.append((ROLE_NAMES.get(role.lower(), role), text))
        else:
            texts = [_text(_at(record, p)) for p in turn.fields]
            if turn.optional and not any(texts):
                continue
            role = _text(_at(record, turn.role_from)) if turn.role_from else turn.role
            made.append((role, "\n\n".join([texts[0], *[t for t in texts[1:] if t]])))
    return made


def canonical_turns(records: DataFrame, keys: list[str], record: str) -> DataFrame:
    """``keys, fingerprint, layout, part, role, text`` from JSON records, a row per
    turn; one row with a null ``part`` for a record without turns."""
    def convert(batches):
        chosen: dict[str, Layout | None] = {}
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                ids = {k: row[k] for k in keys}
                try:
                    parsed = json.loads(row["_record"] or "")
                    paths = {*field_paths(parsed), *partial_paths(parsed)}
                except (ValueError, RecursionError):
                    parsed = None
                if not isinstance(parsed, dict):
                    made.append(ids)
                    continue
                mark = fingerprint(paths)
                if mark not in chosen:
                    chosen[mark] = choose(paths)
                layout = chosen[mark]
                if layout:
                    name, turns = layout.name, apply_layout(parsed, layout)
                else:
                    name, turns = mixed_turns(parsed) or (None, [])
                ids |= {"fingerprint": mark, "layout": name}
                made += [
                    {**ids, "part": i, "role": _whole(role), "text": _whole(text)} for i, (role, text) in enumerate(turns)
                ] or [ids]
            yield pa.RecordBatch.from_pylist(made, schema=to_arrow_schema(schema))

    chosen_columns = records.select(*keys, F.col(record).alias("_record"))
    schema = records.select(*keys).schema
    for name, kind in (("fingerprint", "string"), ("layout", "string"), ("part", "long"), ("role", "string"), ("text", "string")):
        schema = schema.add(name, kind)
    return chosen_columns.mapInArrow(convert, schema)


#: The template: control strings around a turn, and others that readers of such
#: texts give a meaning to.
BEGIN, OPEN, CLOSE = "<s>", "<|turn|>", "</s>"
RESERVED = (
    BEGIN, OPEN, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>", "<|startoftext|>", "<unk>", "<pad>",
)
LOSS_ROLE = "assistant"
_INSIDE = "|".join(f"(?<={re.escape(c[0])}){re.escape(c[1:])}" for c in RESERVED)


def escaped(text: Column) -> Column:
    r"""``\`` doubled, and a ``\`` put after the first character of control strings."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _INSIDE, r"\\$0")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def format_turns(turns: DataFrame, conversation: str, order: list[str]) -> DataFrame:
    """``conv_id, order.., formatted, loss_start, loss_end``: the text of each turn and
    the code points in it, from 0, that the loss is taken on.

    A turn is OPEN, its role, a line break, its text, CLOSE; a line break in a role
    is written as ``\\n``.  BEGIN stands before the first turn of a conversation.
    """
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    text = escaped(F.coalesce("text", F.lit("")))
    start = F.when(F.col("role") == LOSS_ROLE, F.char_length(head))
    return turns.select(
        F.col(conversation).alias("conv_id"), *order, F.concat(head, text, F.lit(CLOSE)).alias("formatted"),
        start.cast("long").alias("loss_start"), (start + F.char_length(text)).cast("long").alias("loss_end"),
    )


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = formatted[len(OPEN):-len(CLOSE)].split("\n", 1)
    return unescape(role), unescape(text)


def read_back(formatted: DataFrame, order: list[str]) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Turns stream by in order, and a conversation is digested as it passes: however
    long, it is never held as a whole.
    """
    def digest(batches):
        state = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        done.append(_digests(state))
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), len(BEGIN)]
                text = row["formatted"]
                role, said = parse_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
                if row["loss_start"] is not None:
                    masked = unescape(text[row["loss_start"]:row["loss_end"]])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(text)
            yield table(done)
        if state is not None:
            yield table([_digests(state)])

    def table(done):
        return pa.RecordBatch.from_pylist([dict(zip(columns, d)) for d in done], schema=to_arrow_schema(schema))

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = formatted.select("conv_id").schema
    for name in columns[1:]:
        schema = schema.add(name, "string" if name.endswith("sha256") else "long")
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return rows.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(digest, schema)


def _digests(state) -> tuple:
    conv, n_turns, turns, chars, loss, length = state
    return conv, n_turns, turns.hexdigest(), chars, loss.hexdigest(), length


def whole_texts(formatted: DataFrame, order: list[str]) -> DataFrame:
    """``conv_id, text, loss``: each conversation as one text with the spans of its
    loss mask; for conversations that fit a row."""
    turns = F.sort_array(F.collect_list(F.struct(*order, "formatted", "loss_start", "loss_end")))
    joined = formatted.groupBy("conv_id").agg(turns.alias("turns"))
    step = F.aggregate(
        "turns",
        F.struct(F.lit(len(BEGIN)).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss")),
        lambda acc, t: F.struct(
            (acc.at + F.char_length(t.formatted)).alias("at"),
            F.when(t.loss_start.isNull(), acc.loss).otherwise(F.concat(acc.loss, F.array(F.struct(
                (acc.at + t.loss_start).alias("start"), (acc.at + t.loss_end).alias("end"))))).alias("loss"),
        ),
    )
    return joined.select(
        "conv_id", F.concat(F.lit(BEGIN), F.array_join("turns.formatted", "")).alias("text"), step.loss.alias("loss")
    )


def format_and_read(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` formatted, written and read back."""
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = rows.select("conv_id", "turn", record.alias("record"))
    turns = canonical_turns(records, ["conv_id", "turn"], "record").filter("part IS NOT NULL")
    path = work_dir(rows.sparkSession, "chats")
    format_turns(turns, "conv_id", ["turn"]).write.parquet(path)
    return read_back(rows.sparkSession.read.parquet(path), ["turn", "formatted"])
