"""Chat formatting by incremental black-box rendering.

The template is only ever called: for each turn the conversation's prefix is rendered without it,
with it, and with a probe character in place of its text. Where the longer output continues the
shorter one, the difference is the turn's span; the probe's place in it tells what stands before and
after the text. Where it doesn't continue it, the template rewrites history: the turn is flagged
(``rewrites``) and gets no span. The probe is a private-use character that neither the turn nor the
output holds.

Whole prefixes are rendered, so one conversation is held by one task and costs time in the square of
its turns. A caller who knows that a turn's rendering depends on at most ``context`` earlier turns may
say so: then only those are rendered again and held, which is linear, and rewriting farther back
goes unseen.

Reading back parses the output of a conversation as one string, whatever rows it came in. A
conversation with a flagged turn has no output: its row has ``n_turns`` and nulls.

Edge cases: a null text or role is empty; equal turn numbers are ordered by role and text; a null
conversation id is one conversation; repeated rows are repeated turns; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
#: Private-use characters that may stand for a text.
PROBES = range(0xE000, 0xF900)

#: The control strings of ``bracket_template`` and what stands for them inside texts.
CONTROL = {
    "[INST]": "\\I",
    "[/INST]": "\\i",
    "<<SYS>>": "\\Y",
    "<</SYS>>": "\\y",
    "[ROLE]": "\\R",
    "[/ROLE]": "\\r",
    "<s>": "\\S",
    "</s>": "\\s",
    "\\": "\\\\",
}
_ESCAPE = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_PLAIN = {v: k for k, v in CONTROL.items()}
_UNESCAPE = re.compile(r"\\.", re.S)
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>|<s> (?P<assistant>.*?) </s>"
    r"|\[ROLE\] (?P<role>[^\n]*)\n(?P<other>.*?) \[/ROLE\]",
    re.S,
)


def escape(text: str) -> str:
    """``text`` without any control string; ``unescape`` restores it."""
    return _ESCAPE.sub(lambda m: CONTROL[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _PLAIN.get(m[0], "\n" if m[0] == "\\n" else m[0]), text)


def bracket_template(turns: list[Turn]) -> str:
    """Marks every turn with control strings; a turn's rendering depends on that turn alone."""
    out = []
    for role, text in turns:
        body = escape(text)
        if role == "user":
            out.append(f"[INST] {body} [/INST]")
        elif role == "system":
            out.append(f"<<SYS>> {body} <</SYS>>")
        elif role == "assistant":
            out.append(f"<s> {body} </s>")
        else:
            out.append(f"[ROLE] {escape(role).replace(chr(10), chr(92) + 'n')}\n{body} [/ROLE]")
    return "".join(out)


class OutputReader:
    """Reads turns from the output of ``bracket_template`` as it grows.

    Texts hold no control string, so the first end mark is a turn's own, and a turn can be taken as
    soon as it is complete: only the incomplete end of the output is held.
    """

    def __init__(self):
        self.rest = ""

    def feed(self, output: str) -> Iterator[Turn]:
        self.rest += output
        at = 0
        while found := _TURN.match(self.rest, at):
            at = found.end()
            if found["role"] is not None:
                yield unescape(found["role"]), unescape(found["other"])
            else:
                yield found.lastgroup, unescape(found[found.lastgroup])
        self.rest = self.rest[at:]

    def close(self) -> None:
        if self.rest:
            raise ValueError("the output ends inside a turn")


def probe_for(*texts: str) -> str:
    """A private-use character that none of ``texts`` holds."""
    return next(c for c in map(chr, chain(PROBES, range(0xF0000, 0xFFFFE))) if not any(c in t for t in texts))


def locate(render: Callable[[list[Turn]], str], before: list[Turn], turn: Turn, shorter: str | None = None) -> tuple[str, int, int] | None:
    """What ``turn`` adds to the rendering of ``before``, and where its text lies in it; None if history changes.

    ``shorter`` is the rendering of ``before``, if the caller has it.
    """
    shorter = render(before) if shorter is None else shorter
    longer = render([*before, turn])
    if not longer.startswith(shorter):
        return None
    probe = probe_for(longer, turn[0])
    probed = render([*before, (turn[0], probe)])
    if not probed.startswith(shorter):
        return None
    at = probed.find(probe, len(shorter))
    if at < 0:
        return None
    tail = len(probed) - at - len(probe)
    if longer[:at] != probed[:at] or (tail and longer[-tail:] != probed[-tail:]):
        return None
    return longer[len(shorter) :], at - len(shorter), len(longer) - tail - len(shorter)


def format_turns(
    conversations: DataFrame,
    render: Callable[[list[Turn]], str] = bracket_template,
    context: int | None = None,
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per turn, in order within each conversation: the formatted conversation is the
    concatenation of ``rendered``.

    Columns: ``conv_id``, ``position``, ``rendered``, ``start`` (offset of the turn in the formatted
    conversation), ``text_start``, ``text_end`` (of the text in ``rendered``), ``loss`` (whether the
    text is trained on), ``rewrites``. Offsets are code points. ``context`` None renders whole prefixes.
    ``rendered`` is null where the template rewrites history.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, turns, start, position, output = None, False, [], 0, 0, ""
        for batch in batches:
            rows = {name: [] for name in ("position", "rendered", "start", "text_start", "text_end", "loss", "rewrites")}
            ids, roles, texts = (batch.column(k).to_pylist() for k in range(3))
            for conv, role, text in zip(ids, roles, texts):
                if not known or conv != current:
                    current, known, turns, start, position = conv, True, [], 0, 0
                    output = render([]) if context is None else ""
                found = locate(render, turns, (role, text), output if context is None else None)
                rendered, a, b = found or (None, None, None)
                rows["position"].append(position), rows["rendered"].append(rendered), rows["start"].append(start)
                rows["text_start"].append(a), rows["text_end"].append(b)
                rows["loss"].append(found is not None and role == loss_role), rows["rewrites"].append(found is None)
                start, position = start + len(rendered or ""), position + 1
                turns.append((role, text))
                if context is not None:
                    turns = turns[len(turns) - context :] if context else []
                else:
                    output = output + rendered if found else render(turns)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(rows.values(), kinds))], ["conv_id", *rows]
            )

    kind = conversations.schema["conv_id"].dataType.simpleString()
    empty = F.lit("")
    ordered = (
        conversations.select(
            "conv_id", F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"), "turn"
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, position long, rendered string, start long, text_start long, text_end long, loss boolean, rewrites boolean",
    )


class _Digests:
    """One conversation as it is read back."""

    def __init__(self, conv: object):
        self.conv, self.given, self.rewritten, self.chars = conv, 0, False, 0
        self.reader, self.read = OutputReader(), 0
        self.turns, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0

    def add(self, rendered: str | None, start: int, end: int, loss: bool) -> None:
        self.given += 1
        self.rewritten |= rendered is None
        if self.rewritten:
            return
        for role, text in self.reader.feed(rendered):
            self.read += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if loss:
            masked = unescape(rendered[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode("utf-8", "surrogatepass"))
        self.chars += len(rendered)

    def row(self) -> tuple:
        if self.rewritten:
            return self.conv, self.given, None, None, None, None
        self.reader.close()
        return self.conv, self.read, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from the rows of ``format_turns`` as they stream by.

    ``n_turns``, ``turns_sha256`` (role, newline, text, newline per turn), ``loss_chars`` and
    ``loss_sha256`` (all text under the loss mask, unescaped), ``formatted_chars``; where a turn is
    flagged, nulls beside the number of rows. Expects rows of one conversation next to each other and
    in order, as ``format_turns`` yields them.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Digests | None = None
        id_kind = pa.int64()

        def done(items: list[_Digests]) -> pa.RecordBatch:
            columns = list(zip(*[s.row() for s in items])) or [[]] * len(names)
            kinds = [id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            id_kind = batch.schema.field(0).type
            closed = []
            for conv, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if state is None or conv != state.conv:
                    closed += [state] if state is not None else []
                    state = _Digests(conv)
                state.add(*row)
            yield done(closed)
        if state is not None:
            yield done([state])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "rendered", "text_start", "text_end", "loss").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
