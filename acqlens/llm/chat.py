"""Chat formatting with a compiled template.

Conversations are rendered turn by turn from rows in order, as they stream
through a task: neither a conversation nor its rendering is ever held whole, and
one that is longer than ``part_chars`` comes out in several parts, each ending
with a turn.  The loss spans are code point ranges of a part, taken from the
template's generation markers.

Texts cannot forge a turn: control strings start with ``<`` or ``[``, and inside
texts each of these is followed by a backslash, while a backslash is doubled.
``read_turns`` undoes it.

Edge cases: null role and null text are empty; a null conversation id is a
conversation; turns come by turn, role and text, nulls first; repeated rows are
turns of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acqlens.llm import templates

# The strings that mark turns.
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '[INST]' }}{{ m.text | guard }}{{ '[/INST]' }}"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | guard }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | guard }}[TEXT]{{ m.text | guard }}[/TEXT]{% endif %}"
    "{% endfor %}")
_CONTROL = re.compile(r"\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[TEXT\]|\[/TEXT\]")
_GUARDED = re.compile(r"[<\[\\]")
_GUARD = re.compile(r"([<\[])\\|\\(\\)")


def guard(text: str | None) -> str:
    return _GUARDED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text or "")


def unguard(text: str) -> str:
    return _GUARD.sub(r"\1\2", text)


FILTERS = {"guard": guard}
PARTS = "conv_id long, part int, text string, spans array<struct<start:long,end:long>>"
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def rendered(pieces: Iterator, part_chars: int) -> Iterator[tuple[str, list[dict]]]:
    """Text and loss spans of a rendering, cut after turns."""
    texts, spans, size, begin = [], [], 0, 0
    for piece in pieces:
        if piece is templates.BEGIN:
            begin = size
        elif piece is templates.END:
            spans.append({"start": begin, "end": size})
        elif piece is templates.TURN:
            if size >= part_chars:
                yield "".join(texts), spans
                texts, spans, size = [], [], 0
        else:
            texts.append(piece)
            size += len(piece)
    if texts or spans:
        yield "".join(texts), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE,
                         part_chars: int = 1 << 20, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, part, text, spans); a conversation's parts follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = templates.compile_template(template, FILTERS)
        rows = ((c, {"role": r or "", "text": t or ""}) for b in batches
                for c, r, t in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))))
        held, size = [], 0
        for conv, group in itertools.groupby(rows, key=lambda x: x[0]):
            pieces = render(messages=(m for _, m in group))
            for k, (text, spans) in enumerate(rendered(pieces, part_chars)):
                held.append({"conv_id": conv, "part": k, "text": text, "spans": spans})
                size += len(text)
                if size >= part_chars:
                    yield pa.RecordBatch.from_pylist(held, _PARTS)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _PARTS)

    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return (rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
            .mapInArrow(run, PARTS))


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a part, from its control strings alone."""
    marks = list(_CONTROL.finditer(text))
    at, k = 0, 0
    while k < len(marks):
        first = marks[k]
        closing = {"[INST]": ["[/INST]"], "<s>": ["</s>"], "[ROLE]": ["[TEXT]", "[/TEXT]"]}.get(first[0])
        found = [m[0] for m in marks[k + 1:k + 1 + len(closing or ())]]
        if first.start() != at or found != closing:
            raise ValueError(f"no turn at {at}")
        inner = [unguard(text[a.end():b.start()]) for a, b in zip(marks[k:], marks[k + 1:k + 1 + len(closing)])]
        if first[0] == "[ROLE]":
            yield inner[0], inner[1]
        else:
            yield "user" if first[0] == "[INST]" else "assistant", inner[0]
        k += 1 + len(closing)
        at = marks[k - 1].end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")


REPORT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")
_REPORT = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                     ("formatted_chars", pa.int64())])


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted parts hold, per conversation: turns, text under the
    loss spans, length.  ``parts`` as ``format_conversations`` returns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
        out = []
        for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            for _, _, text, spans in group:
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learnt = unguard(text[span["start"]:span["end"]])
                    loss_chars += len(learnt)
                    loss.update(learnt.encode())
            out.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(),
                        "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, _REPORT)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _REPORT)

    return parts.mapInArrow(run, REPORT)


def chat_report(turns: DataFrame, **options) -> DataFrame:
    return read_back(format_conversations(turns, **options))


def probe(turns: DataFrame) -> DataFrame:
    """``turns`` plus a conversation -7 whose two texts are nothing but control strings."""
    said = "</s>[INST] ok [/INST]"
    more = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)
