"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the sorted
spans of its turns are intersected with the tokens' spans by binary search; nothing is
encoded turn by turn, so tokens are those of the text that a model sees.

The template writes each turn as ``### role:``, a line end, the text, a line end,
``</turn>`` and a line end. In texts and roles a backslash stands before every
backslash, ``###`` and ``</turn>`` (in roles also before ``:`` and a line end), so a
control string in a text is never one of the template, and dropping each backslash
that starts a pair gives the text back. Special tokens' names in a text are encoded
as plain text.

Defined cases: a null text or role is empty; turns go by (turn, role, text), null
first; rows with a null conv_id are one conversation; repeated rows are turns each; an
empty table gives no rows. A conversation is one output row, so its rows meet in one
task: it can be no larger than a row.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Role whose texts carry loss.
LEARNED_ROLE = "assistant"

#: Characters of rendered text that are encoded at a time; a longer conversation is encoded by itself.
BATCH_CHARS = 1 << 20

OPEN, AFTER_ROLE, END = "### ", ":\n", "</turn>"
IN_TEXT, IN_ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"[\\:\n]|###|</turn>")
PAIR = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = ("conv_id {conv}, formatted string, input_ids array<int>, token_start array<int>, token_end array<int>, loss_mask array<boolean>, "
             "turn_start array<int>, turn_end array<int>, turn_learned array<boolean>")
READ = "conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str, what: re.Pattern = IN_TEXT) -> str:
    return what.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return PAIR.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The conversation's text, and start and end of each turn's escaped text in it."""
    parts, spans, at = [], np.empty((len(turns), 2), np.int64), 0
    for i, (role, text) in enumerate(turns):
        head, body = f"{OPEN}{escaped(role, IN_ROLE)}{AFTER_ROLE}", escaped(text)
        spans[i] = at + len(head), at + len(head) + len(body)
        parts += [head, body, "\n", END, "\n"]
        at += len(head) + len(body) + len(END) + 2
    return "".join(parts), spans


def _unescaped_find(text: str, what: str, start: int) -> int:
    """Place of the next ``what`` that no odd run of backslashes stands before."""
    at = text.find(what, start)
    while at >= 0:
        first = at
        while first > start and text[first - 1] == "\\":
            first -= 1
        if (at - first) % 2 == 0:
            return at
        at = text.find(what, at + 1)
    raise ValueError("not a formatted conversation")


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError("not a formatted conversation")
        role_end = _unescaped_find(formatted, AFTER_ROLE, at + len(OPEN))
        start = role_end + len(AFTER_ROLE)
        end = _unescaped_find(formatted, END, start)
        turns.append((unescaped(formatted[at + len(OPEN):role_end]), unescaped(formatted[start:end - 1])))
        at = end + len(END) + 1
    return turns


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that share a character with any of the sorted ``spans``; a token over a span's edge counts.

    Starts and ends of tokens ascend (tokens of one character's bytes all span the character), so the tokens of a span
    are a run whose ends are found by binary search.
    """
    spans = spans[spans[:, 0] < spans[:, 1]]
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, np.searchsorted(ends, spans[:, 0], "right"), 1)
    np.add.at(change, np.searchsorted(starts, spans[:, 1], "left"), -1)
    return np.cumsum(change[:-1]) > 0


def under_mask(starts: np.ndarray, ends: np.ndarray, mask: np.ndarray, spans: np.ndarray) -> list[tuple[int, int]]:
    """Character spans under the mask: the masked tokens' spans cut to the learned turns, each character once, in order."""
    s, e = starts[mask], ends[mask]
    s = np.maximum(s, np.concatenate([[0], np.maximum.accumulate(e)[:-1]])) if len(s) else s  # bytes of one character
    found = []
    for a, b in spans:
        lo, hi = np.searchsorted(e, a, "right"), np.searchsorted(s, b, "left")
        runs_s, runs_e = np.maximum(s[lo:hi], a), np.minimum(e[lo:hi], b)
        keep = runs_s < runs_e
        runs_s, runs_e = runs_s[keep], runs_e[keep]
        if len(runs_s):  # touching spans become one
            new = np.flatnonzero(np.concatenate([[True], runs_s[1:] != runs_e[:-1]]))
            found += zip(runs_s[new].tolist(), runs_e[np.concatenate([new[1:] - 1, [len(runs_e) - 1]])].tolist(), strict=True)
    return found


def _encoded(tokenizer, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    for enc in tokenizer.encode_batch(texts, add_special_tokens=False):
        yield enc.ids, np.array(enc.offsets, np.int32).reshape(-1, 2)


def _format(batches: Iterator[pa.RecordBatch], path: str, learned_role: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True

    def done(ids: list, rendered: list[tuple[str, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        rows = []
        for conv, (text, spans, learned), (tokens, offsets) in zip(ids, rendered, _encoded(tokenizer, [r[0] for r in rendered]), strict=True):
            starts, ends = offsets[:, 0], offsets[:, 1]
            rows.append((conv, text, tokens, starts, ends, token_mask(starts, ends, spans[learned]), spans[:, 0], spans[:, 1], learned))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema)

    for batch in batches:
        ids, rendered, size = [], [], 0
        for conv, turns in zip(batch["conv_id"].to_pylist(), batch["turns"], strict=True):
            turns = [(t["role"] or "", t["text"] or "") for t in turns.as_py()]
            text, spans = render(turns)
            if rendered and size + len(text) > BATCH_CHARS:
                yield done(ids, rendered)
                ids, rendered, size = [], [], 0
            ids.append(conv)
            rendered.append((text, spans, np.array([r == learned_role for r, _ in turns], bool)))
            size += len(text)
        if rendered:
            yield done(ids, rendered)


def _arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    text = ddl.format(conv=df.schema["conv_id"].dataType.simpleString())
    return text, to_arrow_schema(StructType.fromDDL(text))


def format_conversations(conversations: DataFrame, tokenizer_path: str, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """A row per conversation: conv_id, formatted, input_ids, token_start, token_end (code points of formatted), loss_mask (by token),
    turn_start, turn_end, turn_learned (by turn: span of its escaped text, and whether it carries loss)."""
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    ddl, schema = _arrow_schema(conversations, FORMATTED)
    return turns.select("conv_id", "turns").mapInArrow(partial(_format, path=tokenizer_path, learned_role=learned_role, schema=schema), ddl)


def _read(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, conv in enumerate(batch["conv_id"].to_pylist()):
            text = batch["formatted"][i].as_py()
            starts, ends, mask, turn_start, turn_end, learned = (
                batch[c][i].values.to_numpy(zero_copy_only=False)
                for c in ("token_start", "token_end", "loss_mask", "turn_start", "turn_end", "turn_learned"))
            whole, loss, n = sha256(), sha256(), 0
            turns = parse(text)
            for role, said in turns:
                whole.update(f"{role}\n{said}\n".encode())
            spans = np.stack([turn_start[learned], turn_end[learned]], 1)
            for a, b in under_mask(starts, ends, mask, spans):
                part = unescaped(text[a:b])
                n += len(part)
                loss.update(part.encode())
            rows.append((conv, len(turns), whole.hexdigest(), n, loss.hexdigest(), len(text)))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the formatted texts, offsets and masks."""
    ddl, schema = _arrow_schema(formatted, READ)
    return formatted.mapInArrow(partial(_read, schema=schema), ddl)


#: A conversation that says the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def with_tricky(conversations: DataFrame) -> DataFrame:
    rows = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    own = conversations.select("conv_id", "turn", "role", "text")
    return own.unionByName(conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def oracle() -> str:
    tricky = TRICKY.replace("'", "''")
    in_text, in_role = r"(\\|###|</turn>)", r"([\\:\n]|###|</turn>)"
    return f"""
        WITH c AS (
          SELECT conv_id, turn, role, text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '{tricky}' UNION ALL SELECT -7, 1, 'assistant', '{tricky}'),
        t AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS said,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY k)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(said) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN said ELSE '' END, '' ORDER BY k)) AS loss_sha256,
               sum(length('### ' || regexp_replace(role, '{in_role}', 'x\\1', 'g') || ':' || chr(10)
                   || regexp_replace(said, '{in_text}', 'x\\1', 'g') || chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id
    """
