"""Chat formatting with offset-aligned loss masks.

Conversations are rendered in a template whose control strings are single special tokens, encoded
once with character offsets, and the assistants' spans are found among the tokens by binary search.

Texts may hold control strings: each ``<``, any number of backslashes, ``|`` gets one backslash more,
and one less when read back, so no text can open or close a turn.

A conversation is written in segments of ``SEGMENT`` turn numbers, and a segment in parts of about ``PART`` characters.
Rows are dealt by ranges of conversation, turn, role and text, so a conversation, and even one turn number's rows, may run
through several tasks, whose parts follow each other. As control strings are never merged with text, the parts' tokens are
those of the whole conversation. Digests over a conversation stream through its parts.

Defined results: null texts and roles count as empty; rows of a conversation are taken by turn
(null first), then role and text; repeated rows are turns of their own; a null conv_id is a
conversation of its own; very long texts are formatted whole; an empty table leaves only conversation
-1 in the query, and a conversation -1 of the table has a row beside that one; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
SEGMENT = 64
PART = 250_000
_TASK = 1 << 32  # parts of a task are numbered from its number times this
TRAINED_ROLE = "assistant"

_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END) + "\n", re.S)
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_NONE = -(2**63)
_PROBE = _NONE + 1  # the query's own conversation, until it is -1 in the result
_tokenizers: dict[str, object] = {}


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        t.add_special_tokens([START, MIDDLE, END])
        _tokenizers[path] = t
    return _tokenizers[path]


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """Formatted text, and the sorted spans (start, end) of the assistants' texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{MIDDLE}", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that lie in some span: two binary searches per span over the tokens' starts."""
    mask = np.zeros(len(offsets) + 1, np.int64)
    starts = offsets[:, 0]
    np.add.at(mask, np.searchsorted(starts, spans[:, 0], "left"), 1)
    np.add.at(mask, np.searchsorted(starts, spans[:, 1], "left"), -1)
    return np.cumsum(mask[:-1]) > 0


def format_conversations(rows: DataFrame, tokenizer: str = TOKENIZER, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment, part, formatted, ids, mask: a row for each part of each segment of each conversation."""
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NONE)).alias("conv_id"),
        F.coalesce(F.floor(F.col("turn") / segment), F.lit(_NONE)).cast("long").alias("segment"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first()]
    ranges = rows.repartitionByRange(*order, F.substring("role", 1, 16), F.substring("text", 1, 32))  # bounds come from a sample: beginnings are enough
    dealt = ranges.sortWithinPartitions(*order, "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, begin = _tokenizer(tokenizer), TaskContext.get().partitionId() * _TASK  # ranges follow each other
        held: list[tuple] = []  # (conv_id, segment, part, text, spans) not yet encoded

        def flush() -> pa.RecordBatch:
            encoded = tok.encode_batch([h[3] for h in held], add_special_tokens=False)
            ids, masks = [], []
            for (*_, spans), e in zip(held, encoded, strict=True):
                ids.append(np.array(e.ids, np.int32))
                masks.append(loss_mask(np.array(e.offsets, np.int64).reshape(-1, 2), spans))
            out = pa.RecordBatch.from_arrays(
                [*(pa.array([h[k] for h in held], pa.int64()) for k in range(3)), pa.array([h[3] for h in held], pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))],
                names=["conv_id", "segment", "part", "formatted", "ids", "mask"],
            )
            held.clear()
            return out

        now, part, turns, size, waiting = None, begin, [], 0, 0
        for batch in batches:
            for *key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text")), strict=True):
                if turns and (key != now or size > PART):
                    held.append((*now, part, *render(turns)))
                    part, turns, waiting, size = part + 1, [], waiting + size, 0
                if key != now:
                    now, part = key, begin
                turns.append((role, text))
                size += len(role) + len(text)
                if waiting > 1_000_000:
                    yield flush()
                    waiting = 0
        if turns:
            held.append((*now, part, *render(turns)))
        if held:
            yield flush()

    return dealt.mapInArrow(run, "conv_id long, segment long, part long, formatted string, ids array<int>, mask array<boolean>")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def read_trained(ids: np.ndarray, mask: np.ndarray, tokenizer: str = TOKENIZER) -> list[str]:
    """Texts under the mask, decoded from the tokens of each run."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    runs = [ids[a:b].tolist() for a, b in edge.reshape(-1, 2)]
    return [unescape(x) for x in _tokenizer(tokenizer).decode_batch(runs, skip_special_tokens=False)] if runs else []


def digests(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What the formatted output says, read back: one row per conversation, streamed in order."""
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done, now = [], None

        def close() -> None:
            if now is not None:
                done.append(({_NONE: None, _PROBE: -1}.get(now[0], now[0]), now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for batch in batches:
            for conv, text, ids, mask in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("ids"), batch.column("mask"), strict=True):
                if now is None or now[0] != conv:
                    close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{body}\n".encode())
                for body in read_trained(ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False), tokenizer):
                    now[3] += len(body)
                    now[4].update(body.encode())
                now[5] += len(text)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    return dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def masks_of_conversations(conversations: DataFrame) -> DataFrame:
    """op9: digests of all conversations and of conversation -1, whose texts hold control strings."""
    probe = f"{END}{START}assistant ok"
    extra = conversations.sparkSession.createDataFrame([(_PROBE, 0, "user", probe), (_PROBE, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return digests(format_conversations(conversations.select("conv_id", "turn", "role", "text").union(extra)))


def masks_of_conversations_sql() -> str:
    """The contract itself in DuckDB SQL: escapes cost one character per control string found."""
    fixed = len(START) + len(MIDDLE) + len(END) + 1
    return f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {_PROBE}, t, r, '{END}{START}assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT CASE WHEN conv_id = {_PROBE} THEN -1 ELSE conv_id END AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({fixed} + length(role) + length(text) + len(regexp_extract_all(role, '<\\\\*\\|')) + len(regexp_extract_all(text, '<\\\\*\\|')))::BIGINT AS formatted_chars
FROM rows_ GROUP BY rows_.conv_id
"""
