"""Operator 2: chat formatting on the level of tokens.

Every segment (a turn's text, and the name of a role without ids of its own) is encoded
for itself; reserved ids, which no text can encode to, are spliced between; the loss mask
is the prefix sum of +1 where an assistant's text begins and -1 where it ends. Strings
of the template that occur in content are escaped by a backslash after their first sign,
one more if there are some already, which can be taken back.

    user       [INST] text [/INST]
    assistant  [OUT] text </s>
    others     [ROLE] name [/ROLE] text </s>

The output has a row for each turn: a conversation is its rows in the order of ``turn``.
So no conversation, however long, is held in one place, and only its digests go through
its turns one by one.

Defined results: null text or role is empty; turns with equal ``turn`` are ordered by
role, then text; repeated rows are turns of their own; a null conv_id is one
conversation; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.bpe import load
from murmur.llm.frames import by_size, small_batches, texts_of

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[ROLE]", "[/ROLE]"]
#: Strings that a vocabulary itself takes for ids of its own.
FOREIGN = ["<|endoftext|>", "<|startoftext|>"]
_ENDS = "|".join(re.escape(c[1:]) for c in CONTROLS + FOREIGN)
_PLAIN = re.compile(rf"([<\[])(\\*)({_ENDS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_ENDS})")
ASSISTANT, USER = "assistant", "user"


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def control_ids(path: str) -> dict[str, int]:
    """Reserved ids, directly after those of the vocabulary."""
    base = len(load(path).token_length)
    return {c: base + i for i, c in enumerate(CONTROLS)}


def assemble(roles: list[str], texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, loss mask, bounds) of turns, one after the other."""
    control = control_ids(path)
    segments: list[str] = []
    shape: list[list[tuple[str, bool]]] = []  # of a turn: controls (with "") and segments
    for role, text in zip(roles, texts):
        if role == USER:
            shape.append([("[INST]", False), ("", False), ("[/INST]", False)])
        elif role == ASSISTANT:
            shape.append([("[OUT]", False), ("", True), ("</s>", False)])
        else:
            segments.append(escape(role))
            shape.append([("[ROLE]", False), ("", False), ("[/ROLE]", False), ("", False), ("</s>", False)])
        segments.append(escape(text))
    ids, bounds = load(path).encode(segments)
    of_segment = np.diff(bounds)
    parts = [p for s in shape for p in s]
    is_text = np.array([c == "" for c, _ in parts], bool)
    size = np.ones(len(parts), np.int64)
    size[is_text] = of_segment
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    out = np.zeros(total, np.int32)
    out[(end - size)[~is_text]] = [control[c] for c, _ in parts if c]
    turn_end = np.cumsum([len(s) for s in shape]) if shape else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], end[turn_end - 1]]).astype(np.int64) if shape else np.zeros(1, np.int64)
    text_at = np.ones(total, bool)
    text_at[(end - size)[~is_text]] = False
    out[text_at] = ids
    learnt = np.array([loss for _, loss in parts], bool)
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, (end - size)[learnt], 1)
    np.add.at(change, end[learnt], -1)
    return out, np.cumsum(change)[:total].astype(bool), bounds


def read_turns(ids: list[np.ndarray], loss: list[np.ndarray], path: str) -> list[tuple[str, str, str, int]]:
    """(role, text, text under the mask, signs of the turn as written) of each turn, from
    its ids and mask."""
    control = {i: c for c, i in control_ids(path).items()}
    marks, pieces = [], []
    for own, mask in zip(ids, loss):
        at = np.flatnonzero(own >= min(control)).tolist()
        marks.append([control[i] for i in own[at].tolist()])
        for a, b in zip(at, at[1:]):
            pieces += [own[a + 1 : b], own[a + 1 : b][mask[a + 1 : b]]]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    texts = iter([t.decode() for t in load(path).decode(np.concatenate([*pieces, np.zeros(0, np.int32)]), bounds)])
    out = []
    for own in marks:
        between = [(next(texts), next(texts)) for _ in own[1:]]
        role = {"[INST]": USER, "[OUT]": ASSISTANT}.get(own[0]) or unescape(between[0][0])
        written = sum(map(len, own)) + sum(len(w) for w, _ in between)
        out.append((role, unescape(between[-1][0]), unescape("".join(m for _, m in between)), written))
    return out


def format_chat(turns: DataFrame, path: str, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conversation, turn, _order, ids, loss): the ids and the loss mask of every turn.

    ``_order`` breaks ties of ``turn``. A narrow pass; nothing is shuffled.
    """
    kinds = {c: turns.schema[c].dataType.simpleString() for c in (conversation, turn)}
    schema = f"{conversation} {kinds[conversation]}, {turn} {kinds[turn]}, _order string, ids array<int>, loss array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = texts_of(batch.column(role)), texts_of(batch.column(text))
            for rows in by_size([len(t) + len(r) + 8 for t, r in zip(texts, roles)], 1 << 20):
                ids, loss, bounds = assemble(roles[rows], texts[rows], path)
                offsets = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(conversation)[rows], batch.column(turn)[rows],
                        pa.array([f"{r}\0{hashlib.sha256(t.encode()).hexdigest()}" for r, t in zip(roles[rows], texts[rows])], pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(loss)),
                    ],
                    [f.split()[0] for f in schema.split(", ")],
                )

    return small_batches(turns).select(conversation, turn, role, text).mapInArrow(run, schema)


def read_back(formatted: DataFrame, path: str, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conversation, turn, _order, role, text, loss_text, formatted_chars) from ids and
    mask alone."""
    kinds = {c: formatted.schema[c].dataType.simpleString() for c in (conversation, turn)}
    schema = f"{conversation} {kinds[conversation]}, {turn} {kinds[turn]}, _order string, role string, text string, loss_text string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [np.split(c.flatten().to_numpy(zero_copy_only=False), np.cumsum(c.value_lengths().to_numpy())[:-1]) for c in (batch.column("ids"), batch.column("loss"))]
            read = read_turns(*split, path) if batch.num_rows else []
            columns = [pa.array([r[k] for r in read], pa.string()) for k in range(3)] + [pa.array([r[3] for r in read], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in (conversation, turn, "_order")] + columns, [f.split()[0] for f in schema.split(", ")])

    return small_batches(formatted).mapInArrow(run, schema)


def digest(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of
    turns that were read back.

    A digest goes through its conversation in order by its nature. The turns come sorted
    and are taken one batch at a time, so a very long conversation takes time, not memory.
    """
    kind = turns.schema[conversation].dataType.simpleString()
    schema = f"{conversation} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        now, state, done = None, None, []

        def close() -> list:
            return [now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        def pack(rows: list, of: pa.DataType) -> pa.RecordBatch:
            kinds = [of, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        of = None
        for batch in batches:
            of = batch.column(conversation).type
            columns = [batch.column(c).to_pylist() for c in (conversation, "role", "text", "loss_text", "formatted_chars")]
            for c, role, text, learnt, n in zip(*columns):
                if state is None or c != now:
                    if state is not None:
                        done.append(close())
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += n
            if done:
                yield pack(done, of)
                done = []
        if state is not None:
            yield pack([close()], of)

    return turns.repartition(parts, conversation).sortWithinPartitions(conversation, turn, "_order").mapInArrow(run, schema)


def chat_digests(turns: DataFrame, path: str, **names: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted output."""
    by = {k: v for k, v in names.items() if k in ("conversation", "turn")}
    return digest(read_back(format_chat(turns, path, **names), path, **by), **by)


def with_control_case(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose texts hold strings of a template."""
    columns = ["conv_id", "turn", "role", "text"]
    said = "</s>[INST] ok [/INST]"
    two = turns.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, USER).otherwise(ASSISTANT).alias("role"), F.lit(said).alias("text"),
    )
    return turns.select(*columns).unionByName(two)
