"""Byte-level BPE encoding and decoding with a pair occurrence index.

A partition's texts are split into pieces; the distinct new pieces of a batch
are laid out in one symbol sequence, every adjacent pair is entered with all
its positions, and the merge ranks that occur are applied in ascending order.
Applying a rank merges all its positions and enters the pairs that arise, so
each rank is handled once for the whole partition instead of once per word.
A piece that is one very long run costs time in proportion to its length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The split pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Marks that the pattern takes as a piece of their own where they follow a letter and end the unit.
PLAIN_MARKS = frozenset(".,;:!?")

#: Units that a task remembers; beyond it the memory starts anew, results stay the same.
REMEMBERED = 250_000

#: A space or line end before further white space or the end, or a NUL: such texts are split whole.
AWKWARD = re.compile(r"[ \n](?=\s|\Z)|\A\s|\0")
#: What an ASCII text without any of these, and without white space at its ends, has none of.
ASCII_AWKWARD = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\0")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges, token bytes and special tokens of a ``tokenizer.json`` of kind byte-level BPE."""

    def __init__(self, spec: dict):
        model, letters = spec["model"], byte_letters()
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.width = len(self.token_bytes)
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        #: by rank: left, right, merged
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        arisen = {t: -1 for t in letters}
        for rank, (a, b) in enumerate(merges):
            if max(arisen.get(a, rank), arisen.get(b, rank)) >= rank or arisen.setdefault(a + b, rank) != rank:
                raise ValueError("a merge needs a token that only a later merge makes")
        #: pairs as left * width + right, sorted, and their ranks
        keys = np.array([a * self.width + b for a, b, _ in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, -1).astype(np.int32)
        byte_ids = np.asarray(self.byte_ids, np.int64)
        self.byte_pair_ranks = self.rank((byte_ids[:, None] * self.width + byte_ids[None, :]).ravel())

    def rank(self, pairs: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is no merge."""
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.key_ranks[at], -1)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as fh:
            return cls(json.load(fh))


class PairIndexEncoder:
    """Encodes texts for one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers, through one pair index over all of them."""
        if not pieces:
            return []
        v = self.v
        raw = [p.encode() for p in pieces]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)  # a separator of its own after each piece
        flat = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        sym = np.asarray(v.byte_ids, np.int32)[flat]
        sym[ends - 1] = -1
        rank = v.byte_pair_ranks[flat[:-1].astype(np.int32) * 256 + flat[1:]]
        rank[(sym[:-1] < 0) | (sym[1:] < 0)] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []
        self._enter(index, active, rank, np.arange(len(rank), dtype=np.int32))
        self._merge(sym, index, active)
        kept = sym >= 0
        upto = np.cumsum(kept)[ends - 1] * 4
        ids = sym[kept].astype("<u4").tobytes()
        cuts = [0, *upto.tolist()]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    @staticmethod
    def _enter(index: dict[int, list[np.ndarray]], active: list[int], rank: np.ndarray, at: np.ndarray) -> None:
        """Enter the positions ``at`` of the pairs with these ranks; -1 is no pair."""
        has = rank >= 0
        rank, at = rank[has], at[has]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        firsts = np.flatnonzero(np.diff(rank, prepend=-1)).tolist()
        for r, a, b in zip(rank[firsts].tolist(), firsts, [*firsts[1:], len(at)], strict=True):
            if r in index:
                index[r].append(at[a:b])
            else:
                index[r] = [at[a:b]]
                heapq.heappush(active, r)

    def _merge(self, sym: np.ndarray, index: dict[int, list[np.ndarray]], active: list[int]) -> None:
        """Apply the ranks that occur in ascending order; -1 separates pieces, -2 marks merged-away positions.

        No pair that arises from a merge has a lower rank than it (checked when the
        vocabulary is loaded), so every rank is applied once, to all its positions.
        """
        width = self.v.width
        after = np.arange(1, len(sym) + 1, dtype=np.int32)
        before = np.arange(-1, len(sym), dtype=np.int32)
        while active:
            rank = heapq.heappop(active)
            left, right, merged = self.v.merges[rank]
            chunks = index.pop(rank)
            p = np.unique(np.concatenate(chunks)) if len(chunks) > 1 else np.unique(chunks[0])
            p = p[sym[p] == left]
            q = after[p]
            fits = sym[q] == right
            p, q = p[fits], q[fits]
            if left == right and len(p) > 1:  # of overlapping pairs every second one, from the left
                at = np.arange(len(p))
                starts = np.concatenate(([True], p[1:] != q[:-1]))
                take = (at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 0
                p, q = p[take], q[take]
            if not len(p):
                continue
            sym[p], sym[q] = merged, -2
            n = after[q]
            after[p] = n
            before[n] = p
            b = before[p]
            new = np.concatenate((p, b))
            right_sym, left_sym = sym[n].astype(np.int64), sym[b].astype(np.int64)  # b = -1 reads the last separator
            pairs = np.concatenate((np.where(right_sym < 0, -1, merged * width + right_sym), np.where(left_sym < 0, -1, left_sym * width + merged)))
            self._enter(index, active, self.v.rank(pairs), new)

    def units(self, text: str) -> list[str]:
        """The text cut where no piece can go across: before a space and around a line end, if text follows."""
        if text.isascii() and text and not (text[0].isspace() or text[-1].isspace()):
            awkward = any(map(text.__contains__, ASCII_AWKWARD))
        else:
            awkward = AWKWARD.search(text)
        if awkward:
            return self.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def pieces(self, unit: str) -> list[str]:
        """The pieces of a unit; words of letters, alone or with one mark after them, without the pattern."""
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha():
            return [unit]
        if word[-1:] in PLAIN_MARKS and word[:-1].isalpha():
            return [unit[:-1], word[-1]]
        return self.split(unit)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        parts = [self._units(t) for t in texts]
        fresh = list(set().union(*parts) - self.known.keys())
        pieces = list(map(self.pieces, fresh))
        distinct = list(set().union(*pieces))
        ids = dict(zip(distinct, self.encode_pieces(distinct), strict=True)).__getitem__
        self.known.update(zip(fresh, (ids(p[0]) if len(p) == 1 else b"".join(map(ids, p)) for p in pieces), strict=True))
        get = self.known.__getitem__
        return [b"".join(map(get, units)) for units in parts]

    def _units(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.v.special):
            return self.units(text)
        out: list[str] = []
        for part in self.special.split(text):
            if part in self.v.special:
                self.known.setdefault(part, np.array([self.v.special[part]], "<u4").tobytes())
                out.append(part)
            elif part:
                out += self.units(part)
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.v.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


#: Characters that are encoded together, so that a batch of very long texts stays small.
CHUNK_CHARS = 4_000_000


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in encoded]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, token_ids: the ids of every whole text, null text as the empty one.

    One row per input row, repeated ids included; a null id stays null. An empty
    text has no tokens, an empty table no rows. Special tokens of the vocabulary
    that stand in a text are taken as such. Other columns are not read.
    """
    vocabulary = Vocabulary.load(vocab_path)  # over 1 MB with the function, so Spark broadcasts it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PairIndexEncoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(coder.encode(texts[a:b]))], ["id", "token_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """id, text: the text of every list of ids (null: empty), special tokens included."""
    vocabulary = Vocabulary.load(vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PairIndexEncoder(vocabulary)
        for batch in batches:
            texts = [coder.decode(np.asarray(x.values if x.is_valid else [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocab_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded in one pass.

    ``with_ids`` adds token_ids. Rows as in ``encode``.
    """
    vocabulary = Vocabulary.load(vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PairIndexEncoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                encoded = coder.encode(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), pa.array([len(x) // 4 for x in encoded], pa.int64()),
                           pa.array([hashlib.sha256(x).hexdigest() for x in encoded], pa.string()),
                           pa.array([hashlib.sha256(coder.decode(x).encode()).hexdigest() for x in encoded], pa.string())]
                if with_ids:
                    columns.append(_lists(encoded))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    names = [k.split(" ")[0] for k in kinds.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, kinds)
