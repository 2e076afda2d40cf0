"""Conversations formatted by a compiled template, with the spans that a model is to generate (operator 13).

Each message is rendered by itself, in tasks that get rows whatever their conversation; only
the rendered pieces are shuffled by conversation, sorted by turn, and joined.  The joining task streams: it holds one
piece and one part of about ``part_chars`` characters, so a conversation of any length comes out as several
parts.  A conversation that holds a third of all rows costs one task the time to order and join ready-made pieces, in bounded memory.

Null texts and roles are empty.  Rows are ordered by turn (null first); rows of one turn by their rendered
pieces, so repeated rows stay, one after the other.  Rows with a null conversation id are one conversation.  A very long text is one piece,
never cut.  An empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.chat_template import Escaper, Template, TemplateError, compile_template


@dataclass(frozen=True)
class ChatFormat:
    """A template, its constants and its control strings; compiled where it is used.

    ``turns`` maps a turn's opening control string to (role, closing control string); a turn whose role isn't
    known by its mark has the role as text between the mark and ``text_mark``.
    """

    source: str
    constants: tuple[tuple[str, str], ...]
    controls: tuple[str, ...]
    turns: tuple[tuple[str, str | None, str], ...]
    text_mark: str

    def escaper(self) -> Escaper:
        return Escaper(list(self.controls))

    def template(self) -> Template:
        return compile_template(self.source, dict(self.constants), self.escaper())


#: Users, assistants and systems have marks of their own; any other role is written out.
INSTRUCT = ChatFormat(
    source=(
        "{{ bos }}{% for m in messages %}"
        "{%- if m.role == 'assistant' -%}{{ answer }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ eos }}"
        "{%- elif m.role == 'user' -%}[INST]{{ m.text | escape }}[/INST]"
        "{%- elif m.role == 'system' -%}[SYS]{{ m.text | escape }}[/SYS]"
        "{%- else -%}[ROLE]{{ m.role | escape }}[TEXT]{{ m.text | escape }}[/ROLE]"
        "{%- endif -%}{% endfor %}"
    ),
    constants=(("bos", "<s>"), ("eos", "</s>"), ("answer", "[OUT]")),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"),
    turns=(("[OUT]", "assistant", "</s>"), ("[INST]", "user", "[/INST]"), ("[SYS]", "system", "[/SYS]"), ("[ROLE]", None, "[/ROLE]")),
    text_mark="[TEXT]",
)


def render_messages(conversations: DataFrame, chat: ChatFormat = INSTRUCT, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, turn, piece, spans`` of each row: its part of the output, and the spans of it to generate."""
    rows = conversations.select(F.col(id_col).alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    needed = chat.template().loop_fields
    if needed:  # only then does Spark number the rows of each conversation
        own = Window.partitionBy("conv_id")
        at = F.row_number().over(own.orderBy("turn", "role", "text")) - 1
        rows = rows.select("*", at.alias("at"))
        if "last" in needed:
            rows = rows.select("*", F.count("*").over(own).alias("n"))
    has_last = "last" in needed
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("turn", rows.schema["turn"].dataType),
                           T.StructField("piece", T.StringType()), T.StructField("spans", T.ArrayType(T.LongType()))])

    def run(batches):
        template = chat.template()
        for b in batches:
            roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
            places = b.column(4).to_pylist() if needed else []
            sizes = b.column(5).to_pylist() if has_last else [None] * len(places)
            loops = [{"index": i + 1, "index0": i, "first": i == 0, "last": i + 1 == n} for i, n in zip(places, sizes)] if needed else [None] * len(roles)
            done = [template.render_message(*row) for row in zip(roles, texts, loops)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([p for p, _ in done], pa.string()), pa.array([[x for s in spans for x in s] for _, spans in done], pa.list_(pa.int64()))],
                names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def _conversations(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[bool, tuple]]:
    """(whether a conversation begins, row) of rows that come by conversation."""
    last = ()
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(columns)]):
            yield (row[0],) != last, row
            last = (row[0],)


def format_conversations(conversations: DataFrame, chat: ChatFormat = INSTRUCT, id_col: str = "conv_id", part_chars: int = 1_000_000) -> DataFrame:
    """``conv_id, part, text, spans``: the formatted conversations in parts of whole messages, in order.

    ``spans`` lists start and end of each span to generate, in characters of the part.
    """
    pieces = render_messages(conversations, chat, id_col)
    schema = T.StructType([pieces.schema["conv_id"], T.StructField("part", T.IntegerType()), T.StructField("text", T.StringType()),
                           T.StructField("spans", T.ArrayType(T.LongType()))])
    own_type = pa.schema([("part", pa.int32()), ("text", pa.string()), ("spans", pa.list_(pa.int64()))])
    id_type = pieces.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        template = chat.template()
        before, after = template.before, template.after
        types = pa.schema([pa.field("conv_id", to_arrow_type(id_type)), *own_type])
        done, waiting = [], 0  # finished parts not sent yet, and their characters
        conv, part, texts, chars, spans = None, 0, None, 0, []

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done), types)], schema=types)

        for first, (key, _, piece, own) in _conversations(batches, 4):
            if first or chars + len(piece) > part_chars:
                if texts is not None:
                    done.append((conv, part, "".join(texts) + (after if first else ""), spans))
                    waiting += chars
                conv, part, texts, chars, spans = key, 0 if first else part + 1, [before] if first else [], len(before) if first else 0, []
            texts.append(piece)
            spans.extend(chars + x for x in own)
            chars += len(piece)
            if waiting > part_chars or len(done) >= 4096:
                yield sent()
                done, waiting = [], 0
        if texts is not None:
            done.append((conv, part, "".join(texts) + after, spans))
        if done:
            yield sent()

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece").mapInArrow(run, schema)


class Reader:
    """Turns read back from formatted parts, message by message."""

    def __init__(self, chat: ChatFormat):
        self.escaper = chat.escaper()
        self.opening = {mark: (role, close) for mark, role, close in chat.turns}
        self.text_mark, self.template = chat.text_mark, chat.template()

    def turns(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn in a part of whole messages."""
        marks = iter(self.escaper.marks.finditer(text))
        for m in marks:
            if m[0] not in self.opening:
                if m[0] in self.template.before + self.template.after:
                    continue
                raise TemplateError(f"{m[0]!r} at {m.start()} opens no turn")
            role, close = self.opening[m[0]]
            start, end = m.end(), next(marks, None)
            if role is None and end and end[0] == self.text_mark:
                role, start, end = self.escaper.unescape(text[start : end.start()]), end.end(), next(marks, None)
            if role is None or not end or end[0] != close:
                raise TemplateError(f"turn at {m.start()} isn't closed")
            yield role, self.escaper.unescape(text[start : end.start()])


def read_back(parts: DataFrame, chat: ChatFormat = INSTRUCT, arranged: bool = False) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from formatted parts alone.

    ``arranged`` says that the parts come straight from ``format_conversations``, each conversation's in order in one task;
    parts that were stored are brought into that order first.
    """
    if not arranged:
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = T.StructType([parts.schema["conv_id"], *[T.StructField(n, T.LongType() if n.endswith(("turns", "chars")) else T.StringType())
                                                      for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")]])
    id_type = parts.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        reader = Reader(chat)
        kinds = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done, state = [], None

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], names=schema.fieldNames())

        def finished():
            key, n, turns, chars, loss, formatted = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

        for first, (key, _, text, spans) in _conversations(batches, 4):
            if first:
                if state:
                    done.append(finished())
                state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, own in reader.turns(text):
                state[1] += 1
                state[2].update(f"{role}\n{own}\n".encode())
            for start, end in zip(spans[::2], spans[1::2]):
                own = reader.escaper.unescape(text[start:end])
                state[3] += len(own)
                state[4].update(own.encode())
            state[5] += len(text)
            if len(done) >= 4096:
                yield sent()
                done = []
        if state:
            done.append(finished())
            yield sent()

    return parts.mapInArrow(run, schema)
