"""Chat formatting by columnar byte assembly.

Conversations are dealt by id and sorted by turn; a task then walks over its turns batch by batch. Of a
batch, every turn is four segments (opening mark, role, text, closing mark). Their
lengths, summed up, give each segment's offset, and one scatter in numpy copies all bytes into one
buffer that becomes the Arrow column of formatted text without a further copy. Loss spans
follow from the same offsets, in code points.

The template is ``<s>[INST] role\\ntext [/INST]`` for a turn to be answered and
``<s>role\\ntext</s>`` for an assistant's turn, whose text is under the loss mask. Within roles and texts a control string
gets a backslash behind its first character, and one that has backslashes there one more; so no control
string is left in them, and taking one backslash away gives the text back. In a role,
line ends and backslashes are escaped besides.

A conversation is given in parts of whole turns, each of at most a batch, so a conversation of a third of
all rows is never held as one value.

Defined cases: a null role or text is an empty one. Turns of equal number follow in order of role and text, null turns
come first; rows that are equal stay. A null id is a conversation of its own. A long text is one turn
in one part. An empty table gives no part. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from granary.llm.common import rounds

#: The marks of the template.
ASSISTANT = "assistant"
ASKED, ANSWERED = (b"<s>[INST] ", b" [/INST]"), (b"<s>", b"</s>")
#: A control string, or one that has been escaped: its first character, backslashes, the rest.
CONTROL, ESCAPED = r"([<\[])(\\*)(/?(?:s>|INST\]))", r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
TURN = re.compile(r"<s>(?:\[INST\] ([^\n]*)\n(.*?) \[/INST\]|([^\n]*)\n(.*?)</s>)", re.DOTALL)


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, CONTROL, r"\1\2\\\3")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def escape_role(roles: pa.Array) -> pa.Array:
    plain = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    return escape(plain)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def assemble(segments: list[list[bytes] | pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """All rows' segments in one buffer, and the offset of every segment (rows by segments, and the end)."""
    columns = [s if isinstance(s, pa.Array) else pa.array(s, pa.binary()) for s in segments]
    sources, starts, lengths = [], [], []
    base = 0
    for column in columns:
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        own = whole[offsets[0] : offsets[-1]]
        sources.append(own)
        starts.append(offsets[:-1] - offsets[0] + base)
        lengths.append(np.diff(offsets))
        base += len(own)
    source = np.concatenate(sources)
    starts, lengths = np.stack(starts, 1).ravel(), np.stack(lengths, 1).ravel()
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    out = np.empty(int(offsets[-1]), np.uint8)
    out[:] = source[np.repeat(starts - offsets[:-1], lengths) + np.arange(len(out))]
    return out, offsets


def characters(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points before each offset of UTF-8 bytes."""
    return np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))[offsets]


def formatted(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
              role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``id, part, n_turns, text, loss``: parts of each conversation in order.

    ``loss`` holds the spans of the mask in code points of the part, the end excluded. A part is
    numbered by its first turn, and a conversation's parts lie in order in one partition.
    """
    rows = conversations.select(
        F.col(id_column).alias("id"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "part", "n_turns", "text", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0  # the conversation at the end of the batch before, and its turns so far
        for batch in rounds(batches, "text"):
            roles, ids = batch.column("role"), batch.column("id")
            answer = pc.equal(roles, ASSISTANT).to_numpy(zero_copy_only=False)
            marks = [[(ANSWERED if a else ASKED)[i] for a in answer.tolist()] for i in (0, 1)]
            lines = pc.binary_join_element_wise(escape_role(roles), "", "\n")
            buffer, offsets = assemble([marks[0], lines, escape(batch.column("text")), marks[1]])
            code = characters(buffer, offsets)
            values = ids.to_pylist()
            cuts = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
            ends = offsets[4 * np.array(cuts[1:])]
            texts = pa.LargeStringArray.from_buffers(
                len(cuts) - 1, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64).tobytes()), pa.py_buffer(buffer)
            )
            parts, spans = [], []
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                seen = seen if last == (values[begin],) else 0
                parts.append(seen)
                last, seen = (values[begin],), seen + end - begin
                first = code[4 * begin]
                spans.append([{"begin": int(code[4 * i + 2] - first), "end": int(code[4 * i + 3] - first)} for i in range(begin, end) if answer[i]])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cuts[:-1])), pa.array(parts, pa.int64()), pa.array(np.diff(cuts), pa.int64()),
                 texts.cast(pa.string()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))], names,
            )

    return ordered.mapInArrow(run, f"id {kind}, part long, n_turns long, text string, loss array<struct<begin:long,end:long>>").withColumnRenamed("id", id_column)


def parsed(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a part."""
    out, at = [], 0
    while at < len(text):
        found = TURN.match(text, at)
        role, body = (found[1], found[2]) if found[1] is not None else (found[3], found[4])
        out.append((unescape_role(role), unescape(body)))
        at = found.end()
    return out


def read_back(parts: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Counts and digests of each conversation, from its formatted parts and their masks alone."""
    rows = parts.select(F.col(id_column).alias("id"), "part", "text", "loss").repartition("id").sortWithinPartitions("id", "part")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def row(name, state):
            turns, n, chars, loss, long = state
            return {"id": name, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": long}

        def out(done: list[dict], kind: pa.DataType) -> pa.RecordBatch:
            fields = [("id", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            return pa.RecordBatch.from_pylist(done, pa.schema(fields))

        for batch in rounds(batches, "text"):
            done = []
            own = batch.column("id").type
            for name, text, spans in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "loss")), strict=True):
                if last != (name,):
                    if last:
                        done.append(row(last[0], state))
                    last, state = (name,), [sha256(), 0, 0, sha256(), 0]
                for role, body in parsed(text):
                    state[0].update(f"{role}\n{body}\n".encode())
                    state[1] += 1
                for span in spans:
                    masked = unescape(text[span["begin"] : span["end"]])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
            yield out(done, own)
        if last:
            yield out([row(last[0], state)], own)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)
