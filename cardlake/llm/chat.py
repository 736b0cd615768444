"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Texts and roles may hold the control strings themselves.  ``render_turn``
writes a turn as it is, reparses it with the deterministic parser, compares
the recovered turn with its source, and escapes the conflicting content until
both are identical:

* in texts and roles ``<``, any number of backslashes, ``|`` gets one more
  backslash before the ``|`` (so no ``<|`` is left, and taking one backslash
  away again restores the source exactly);
* in roles, which end at the first line end, backslashes and line ends are
  written ``\\\\`` and ``\\n`` first.

The parser decides nothing by context: a turn either uses the escaped form or
it doesn't, told by the start mark (``<|im_start|>`` or ``<|im_start_esc|>``).

Defined cases: null text or role is empty; turns are ordered by turn (null
first), then role, then text, so ties and repeated rows have a fixed order;
an empty conversation table gives the rows of the extra turns alone; extra
columns are ignored.

Skew: rendering is per row.  The digests of a conversation are sequential by
nature, so rows are partitioned by conversation, sorted inside the partition
and hashed as a stream: memory holds one Arrow batch and one hash state,
however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, START_ESC, END = "<|im_start|>", "<|im_start_esc|>", "<|im_end|>"
_OPEN = re.compile(r"<(\\*)\|")
_OPEN_ESC = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPEN_ESC.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _written(role: str, text: str, escaped: bool) -> str:
    if escaped:
        return f"{START_ESC}{escape_role(role)}\n{escape(text)}{END}\n"
    return f"{START}{role}\n{text}{END}\n"


def render_turn(role: str, text: str) -> str:
    """The turn in the form that reparses to itself."""
    for escaped in (False, True):
        out = _written(role, text, escaped)
        try:
            if [t[:2] for t in parse(out)] == [(role, text)]:
                return out
        except ValueError:
            pass
    raise ValueError(f"no form of this turn reparses to itself: {role[:40]!r}")


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn; begin and end bound the text as written.

    Grammar: ``(START ROLE "\\n" TEXT END "\\n")*`` where ROLE has no line end
    and neither ROLE nor TEXT holds ``<|``.  Anything else raises ValueError.
    """
    at = 0
    while at < len(formatted):
        escaped = formatted.startswith(START_ESC, at)
        if not escaped and not formatted.startswith(START, at):
            raise ValueError(f"no start mark at {at}")
        at += len(START_ESC if escaped else START)
        line = formatted.find("\n", at)
        stop = formatted.find("<|", at)
        if line < 0 or stop < line + 1 or not formatted.startswith(END + "\n", stop):
            raise ValueError(f"no turn end after {at}")
        role, text = formatted[at:line], formatted[line + 1:stop]
        if escaped:
            role, text = unescape_role(role), unescape(text)
        yield role, text, line + 1, stop
        at = stop + len(END) + 1


def format_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv, turn, role, text, ``formatted`` (the rendered turn).

    The formatted text of a conversation is the concatenation of its turns in
    the order (turn, role, text).
    """
    src = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))

    def render(batches):
        for b in batches:
            out = [render_turn(r, t) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())],
                                             names=[*b.schema.names, "formatted"])

    kind = dict(src.dtypes)
    return src.mapInArrow(render, f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, "
                                  "text string, formatted string")


CONVERSATION = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                "loss_sha256 string, formatted_chars long, mask_chars long")


def read_back(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation, from the parsed ``formatted`` text alone.

    ``mask_chars`` counts the code points of formatted text under the loss mask.
    """
    ordered = (turns.select(F.col("conv_id").cast("long"), "turn", "role", "text", "formatted")
               .repartition("conv_id")
               .sortWithinPartitions(F.col("conv_id").asc_nulls_first(),
                                     F.col("turn").asc_nulls_first(), "role", "text")
               .select("conv_id", "formatted"))

    def fold(batches):
        row, state = None, None

        def done():
            n, whole, loss, chars, size, mask = state
            return (row, n, whole.hexdigest(), chars, loss.hexdigest(), size, mask)

        for b in batches:
            out = []
            for conv, formatted in zip(b["conv_id"].to_pylist(), b["formatted"].to_pylist()):
                if state is None or conv != row:
                    if state is not None:
                        out.append(done())
                    row, state = conv, [0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                state[4] += len(formatted)
                for role, text, begin, end in parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role in loss_roles:
                        state[2].update(text.encode())
                        state[3] += len(text)
                        state[5] += end - begin
            if out:
                yield _rows(out)
        if state is not None:
            yield _rows([done()])

    return ordered.mapInArrow(fold, CONVERSATION)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in CONVERSATION.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
