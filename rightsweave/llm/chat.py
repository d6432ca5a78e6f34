"""Chat formatting: conversations rendered by a compiled template, and read back from what was rendered.

Turns of a conversation come to one task in order and are rendered as a
stream, so that a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship
from .templates import compile_template

#: Begins a turn, ends its role, and ends the turn.
TURN, SAYS, END = "### ", ": ", "</turn>"
#: One line per turn, the assistant's text marked as generated.
TEMPLATE = """\
{%- for message in messages -%}
{{ '### ' ~ message.role|role ~ ': ' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.text|escape }}{% endgeneration %}
{%- else -%}
{{ message.text|escape }}
{%- endif -%}
{{ '</turn>' + '\\n' }}
{%- endfor -%}
"""
_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE = re.compile(r"\\|### |</turn>|: ")


def escape(text: str | None) -> str:
    """A backslash before each backslash and each control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text or "")


def escape_role(role: str | None) -> str:
    """As ``escape``, and before the string that ends a role; a colon at the role's end is marked too."""
    found = _ROLE.sub(lambda m: "\\" + m[0], role or "")
    return found[:-1] + "\\:" if found.endswith(":") else found


_READ = re.compile(r"\\(.)|(### )|(</turn>)|(: )|([^\\#<:]+|.)", re.S)


class Reader:
    """Reads turns back from rendered pieces: (role, text, loss) with escapes undone.

    A piece is a (text, generated) pair; ``loss`` is the part of the turn's
    text that was generated.  Control strings never lie across pieces.
    """

    def __init__(self) -> None:
        self.state, self.role, self.text, self.loss = "out", [], [], []

    def feed(self, piece: str, generated: bool) -> Iterator[tuple[str, str, str]]:
        for m in _READ.finditer(piece):
            escaped, turn, end, says, plain = m.groups()
            if turn and self.state == "out":
                self.state = "role"
            elif says and self.state == "role":
                self.state = "text"
            elif end and self.state == "text":
                yield "".join(self.role), "".join(self.text), "".join(self.loss)
                self.state, self.role, self.text, self.loss = "out", [], [], []
            elif self.state != "out":
                part = escaped if escaped is not None else m[0]
                (self.role if self.state == "role" else self.text).append(part)
                if generated:
                    self.loss.append(part)


class Digest:
    """What a formatted conversation says when it is read back."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.reader = Reader()

    def add(self, piece: str, generated: bool) -> None:
        self.chars += len(piece)
        for role, text, loss in self.reader.feed(piece, generated):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.loss.update(loss.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(loss)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(3)))


def _conversations(turns: DataFrame) -> DataFrame:
    """conv_id, role and text, each conversation in one task in the order of its turns."""
    return (turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text"))


def _messages(rows: Iterable[tuple]) -> Iterator[dict]:
    for _, role, text in rows:
        yield {"role": role or "", "text": text or ""}


def formatted_turns(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, piece, text and generated: the rendered conversations in pieces, in order of ``piece``.

    Joined together the pieces of a conversation are its formatted text;
    pieces with ``generated`` are the loss mask.
    """
    ship(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape, "role": escape_role})
        for conv_id, rows in groupby(_turns(batches), key=lambda r: r[0]):
            held = []
            for number, (text, generated) in enumerate(render(messages=_messages(rows))):
                held.append({"conv_id": conv_id, "piece": number, "text": text, "generated": generated})
                if len(held) == 1000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())])
    return _conversations(turns).mapInArrow(run, "conv_id bigint, piece bigint, text string, generated boolean")


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id and what the formatted text of each conversation says when read back.

    ``turns`` has conv_id, turn, role and text; other columns are ignored.  Null
    texts and roles are empty; turns come by turn (nulls first), then role and
    text; rows with a null conv_id are one conversation.  An empty table gives
    an empty result.
    """
    ship(turns.sparkSession)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape, "role": escape_role})
        held = []
        for conv_id, rows in groupby(_turns(batches), key=lambda r: r[0]):
            digest = Digest()
            for piece in render(messages=_messages(rows)):
                digest.add(*piece)
            held.append(dict(zip(names, (conv_id, *digest.row()))))
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return _conversations(turns).mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                            "loss_sha256 string, formatted_chars bigint")
