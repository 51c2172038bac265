"""Rebuild conversations from their event logs and render them for training.

A log has a row for each event of a message: ``delta`` adds text, ``edit`` puts
another text in its place, ``regenerate`` throws the attempt away so that deltas
write it anew, ``delete`` removes the message unless later events write it again.
The log is partitioned by conversation and sorted by message and sequence number,
and one pass folds the events and renders the result. A message's role is the last
one that an event of it names.

The template is that of ``turn``: a start mark, the role, a line end, the text, an
end mark. Control strings in roles and texts (``CONTROLS``, and the backslash that
marks them) get a backslash in front, so every mark without one is the template's
and ``parse`` gets back what went in. A control string begins with ``<`` or ``[``,
ends with ``>`` or ``]`` and has neither in between, so none can arise where a text
meets a mark. The loss mask holds the assistant's texts, without marks.

A conversation is one or more parts, in the order of ``block`` and ``part``: long ones are dealt
out by blocks of ``BLOCK`` messages, and a part ends when it has ``PART`` characters. So no
task holds more than a part and a message, however long a conversation is; only
its digest reads it as a whole, as a stream of finished parts.

Null text and null role count as empty, a null conversation is one of its own, null
message and sequence numbers come first. Events of one sequence number go by kind,
then text. Messages that claim the same number are told apart by ``copy``. Unknown
kinds fail. An empty log gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tideline.llm.tokens import small

START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<s>", "</s>", "[INST]", "[/INST]")
TRAINED = ("assistant",)
BLOCK, PART = 1024, 1 << 16
#: Characters of finished rows that a task holds.
HELD = 1 << 20
#: Length of the pieces in which messages are logged as a stream.
PIECE = 200

_ANY = "|".join(map(re.escape, CONTROLS))
_MARKED = re.compile(rf"\\|{_ANY}")
_MARKED_ROLE = re.compile(rf"\\|\n|{_ANY}")
_ESCAPED = re.compile(rf"\\(\\|\n|{_ANY})")
_SCAN = re.compile(rf"\\(?:\\|\n|{_ANY})|({re.escape(START)}|{re.escape(END)})")
_ROLE_END = re.compile(rf"\\(?:\\|\n|{_ANY})|(\n)")


# --- template --------------------------------------------------------------------


def escape(text: str) -> str:
    return _MARKED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the escaped text, that text, and what stands behind it."""
    return f"{START}{_MARKED_ROLE.sub(r'\\\g<0>', role)}\n", escape(text), f"{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts that ``turn`` rendered, one after another."""
    out, begin = [], 0
    for m in _SCAN.finditer(formatted):
        if m[1] == START:
            begin = m.end()
        elif m[1] == END:
            cut = next(e for e in _ROLE_END.finditer(formatted, begin, m.start()) if e[1])
            out.append((unescape(formatted[begin : cut.start()]), unescape(formatted[cut.end() : m.start()])))
    return out


# --- folding and rendering -------------------------------------------------------


class Message:
    """What the events of one message have made of it so far."""

    def __init__(self):
        self.role, self.pieces, self.there = "", [], False

    def apply(self, kind: str, role: str | None, text: str | None) -> None:
        if kind not in ("delta", "edit", "regenerate", "delete"):
            raise ValueError(f"unknown kind of event: {kind}")
        if kind != "delta":
            self.pieces.clear()
        if text and kind in ("delta", "edit"):
            self.pieces.append(text)
        self.role = self.role if role is None else role
        self.there = kind != "delete"


def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``conv_id, block, role, text`` of every message; the events come sorted."""
    key, state = None, Message()
    for batch in small(batches, 1024):
        conv, block, message, copy, kind, role, text = (c.to_pylist() for c in batch.columns)
        for i, name in enumerate(zip(conv, block, message, copy)):
            if name != key:
                if key and state.there:
                    yield *key[:2], state.role, "".join(state.pieces)
                key, state = name, Message()
            state.apply(kind[i], role[i], text[i])
    if key and state.there:
        yield *key[:2], state.role, "".join(state.pieces)


def _renderer(trained: tuple[str, ...], schema: pa.Schema) -> Callable:
    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        texts: list[str] = []
        key, part, n, at, held, loss = None, 0, 0, 0, 0, []

        def close() -> None:
            rows.append(
                {"conv_id": key[0], "block": key[1], "part": part, "n_turns": n, "formatted": "".join(texts), "loss": list(loss)}
            )
            texts.clear()
            loss.clear()

        for conv, block, role, text in folded(batches):
            if key != (conv, block):
                if n:
                    close()
                key, part, n, at = (conv, block), 0, 0, 0
            elif at >= PART:
                close()
                part, n, at = part + 1, 0, 0
            if held >= HELD:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows.clear()
                held = 0
            before, inner, after = turn(role, text)
            if role in trained:
                loss.append({"start": at + len(before), "end": at + len(before) + len(inner)})
            texts += before, inner, after
            size = len(before) + len(inner) + len(after)
            n, at, held = n + 1, at + size, held + size
        if n:
            close()
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return render


def render_log(log: DataFrame, *, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """``conv_id, block, part, n_turns, formatted, loss`` of every conversation in a log.

    ``log``: conv_id, message, copy, seq, kind, role, text. ``loss`` has the places of
    trained texts in ``formatted``, in code points, end exclusive.
    """
    order = ["conv_id", "block", "message", "copy", "seq", "kind", "text"]
    block = F.floor(F.col("message") / BLOCK)
    rows = log.withColumn("block", block).select("conv_id", "block", "message", "copy", "seq", "kind", "role", "text")
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions(*order).drop("seq")
    kind = log.schema["conv_id"].dataType
    schema = (
        f"conv_id {kind.simpleString()}, block long, part int, n_turns long, formatted string, "
        "loss array<struct<start: long, end: long>>"
    )
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.schema(
        [
            ("conv_id", to_arrow_type(kind)),
            ("block", pa.int64()),
            ("part", pa.int32()),
            ("n_turns", pa.int64()),
            ("formatted", pa.string()),
            ("loss", pa.list_(span)),
        ]
    )
    return dealt.mapInArrow(_renderer(trained, arrow), schema)


# --- reading back ----------------------------------------------------------------


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 64):
        rows = {"turns": [], "n_turns": [], "loss": [], "n_chars": []}
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
            found = parse(text)
            rows["turns"].append("".join(f"{role}\n{said}\n" for role, said in found))
            rows["n_turns"].append(len(found))
            rows["loss"].append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
            rows["n_chars"].append(len(text))
        own = [batch.column(k) for k in ("conv_id", "block", "part")]
        read = [pa.array(rows["n_turns"], pa.int64()), pa.array(rows["n_chars"], pa.int64())]
        texts = [pa.array(rows[k], pa.string()) for k in ("turns", "loss")]
        yield pa.RecordBatch.from_arrays(own + read + texts, names=["conv_id", "block", "part", "n_turns", "n_chars", "turns", "loss"])


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    key, of, out = None, None, []

    def made() -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in out], kind), *(pa.array([r[i] for r in out]) for i in range(1, 6))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def close() -> None:
        n, turns, chars, loss, size = of
        out.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

    for batch in small(batches, 64):
        kind = batch.schema.field("conv_id").type
        for conv, n, size, turns, loss in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (conv,):
                if key:
                    close()
                key, of = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            of[0] += n
            of[1].update(turns.encode("utf-8", "surrogatepass"))
            of[2] += len(loss)
            of[3].update(loss.encode("utf-8", "surrogatepass"))
            of[4] += size
        if len(out) >= 4096:
            yield made()
            out.clear()
    if key:
        close()
        yield made()


def read_back(parts: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, from rendered parts alone.

    Parts are parsed where they are; the digests then read each conversation's
    parts in order, one at a time.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    read = parts.mapInArrow(
        _read, f"conv_id {kind}, block long, part int, n_turns long, n_chars long, turns string, loss string"
    )
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").drop("block", "part")
    return ordered.mapInArrow(
        _digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


# --- a log for finished conversations --------------------------------------------


def log_of(messages: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The log that a chat service would have kept of finished messages.

    An assistant's text was first begun in another way, then regenerated; any
    other text was first sent without its second half, then edited. All texts
    arrive in pieces of ``PIECE`` code points. Of rows with one number, role and text
    decide the order.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    rows = messages.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("message"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        said.alias("text"),
    )
    same = Window.partitionBy("conv_id", "message").orderBy("role", "text")
    rows = rows.withColumn("copy", F.row_number().over(same))
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / PIECE)),
        lambda i: F.substring(F.col("text"), (i * PIECE + 1).cast("int"), F.lit(PIECE)),
    )

    def event(kind: str, said):
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"))

    streamed = F.transform(pieces, lambda p: event("delta", p))
    first = event("delta", F.concat(F.lit("Well, "), F.substring("text", 1, 40)))
    half = event("delta", F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int")))
    again = F.concat(F.array(first, event("regenerate", F.lit(None).cast("string"))), streamed)
    edited = F.concat(F.array(half, event("edit", F.element_at(pieces, 1))), F.slice(streamed, F.lit(2), F.size(streamed)))
    events = F.when(F.col("role") == "assistant", again).otherwise(edited)
    return rows.select("conv_id", "message", "copy", "role", F.posexplode(events).alias("seq", "event")).select(
        "conv_id", "message", "copy", F.col("seq").cast("long").alias("seq"), "event.kind", "role", "event.text"
    )
