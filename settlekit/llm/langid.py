"""Language ID by compression with per-language raw-content dictionaries.

For each language, whole texts of a bounded sample of labelled rows become a
zstandard raw-content dictionary. A text's words are encoded with every dictionary, in
pieces of ``PIECE_BYTES`` so that a dictionary counts as much at the end of a long text
as at its start; the language whose encoding is smallest is chosen. The text is
rejected when the margin is narrow: the runner-up comes within ``MIN_MARGIN`` bytes,
or the encoding without a dictionary does once it is cut by the share that a wrong
dictionary saves too. That share is calibrated, per length, on labelled rows that no
dictionary holds: on what each row's own dictionary saves against what the others save
on it, and on what any saves on the row with the letters of its words shuffled. The
dictionaries are a fraction of a MB each and travel with the task; there is no shuffle.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, crc_bucket

UNKNOWN = "und"

#: Rows that a dictionary is chosen from, per language, and its size; of the rows one in HELD_OUT calibrates instead.
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 200_000
HELD_OUT = 4
#: Calibrating rows of all languages together (4 of each at least), and the other languages' dictionaries that each is held against.
CALIBRATE_ROWS, AGAINST = 400, 8
LEVEL = 6
#: Bytes that are encoded at a time, and the lengths at which the savings are calibrated.
PIECE_BYTES = 8_192
LENGTHS = (32, 64, 128, 256, 512, 1_024, 2_048, 4_096, 8_192)
#: Bytes by which the runner-up must be longer; a tie is narrow.
MIN_MARGIN = 1
#: Quantiles of the right and of the wrong savings that a floor lies between, and the rows below which the right one is halved.
LOW, HIGH, FEW_ROWS = 0.05, 0.9, 20
#: Nats that a byte of difference is worth in the score.
NATS_A_BYTE = 0.5

WORD = re.compile(r"[^\W\d_]+")


def normal_form(text: str) -> bytes:
    """The whole text as lower-case words, each run of one word once; empty without a letter."""
    words = WORD.findall(text.lower())
    joined = " ".join([w for w, previous in zip(words, ["", *words], strict=False) if w != previous])
    return f" {joined} ".encode() if any(map(str.isalpha, joined)) else b""


def pieces(form: bytes) -> list[bytes]:
    """The whole form in pieces of at most ``PIECE_BYTES``, cut after a space where there is one."""
    out, at = [], 0
    while len(form) - at > PIECE_BYTES:
        end = form.rfind(b" ", at + 1, at + PIECE_BYTES) + 1 or at + PIECE_BYTES
        out.append(form[at:end])
        at = end
    return [*out, form[at:]]


@dataclass
class LanguageModel:
    """A dictionary for each language, the most frequent language first, and its (length, share) pairs: up to which length of a
    text's form it must, as the best one, save more than which share of the encoding without a dictionary."""

    dictionaries: dict[str, bytes]
    floors: dict[str, list[tuple[int, float]]] = field(default_factory=dict)

    def encoders(self) -> Encoders:
        return Encoders(self)


class Encoders:
    """A task's compressors: one per language, and one without a dictionary."""

    def __init__(self, model: LanguageModel):
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by_lang = {lang: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), **plain)
                        for lang, d in model.dictionaries.items()}
        self.without, self.floors = zstandard.ZstdCompressor(**plain), model.floors

    def size(self, form: bytes, lang: str | None) -> int:
        compress = (self.without if lang is None else self.by_lang[lang]).compress
        return sum(len(compress(p)) for p in pieces(form))

    def floor(self, form: bytes, lang: str) -> float:
        """The share that a text of this length must save to be of the language."""
        known = self.floors[lang]
        return next((share for length, share in known if len(form) <= length), known[-1][1])


def decide(text: str | None, encoders: Encoders) -> tuple[str, float, int]:
    """Language, score and margin in bytes (ties go to the more frequent language)."""
    form = normal_form(text or "")
    if not form or not encoders.by_lang:
        return UNKNOWN, 0.0, 0
    sizes = [encoders.size(form, lang) for lang in encoders.by_lang]
    best = min(sizes)
    lang = list(encoders.by_lang)[sizes.index(best)]
    rest = sorted(sizes)[1:]
    score = 1.0 / math.fsum([1.0, *(math.exp(-NATS_A_BYTE * min(s - best, 1000)) for s in rest)])
    margin = rest[0] - best if rest else len(form)
    if lang in encoders.floors:
        margin = min(margin, math.floor((1.0 - encoders.floor(form, lang)) * encoders.size(form, None)) - best)
    return lang, score, margin


def _cut(form: bytes, length: int) -> bytes:
    """The words that fit the length; all of a shorter form's."""
    return form if len(form) <= length else form[:form.rfind(b" ", 1, length) + 1 or length]


def _scrambled(form: bytes, draw: random.Random) -> bytes:
    """The form with its letters dealt anew over its words."""
    text = form.decode(errors="ignore")
    letters = [c for c in text if c != " "]
    draw.shuffle(letters)
    left = iter(letters)
    return "".join(c if c == " " else next(left) for c in text).encode()


def calibrated(dictionaries: dict[str, bytes], held: dict[str, list[bytes]]) -> LanguageModel:
    """The model with the floors that labelled rows outside the dictionaries (``held``: forms by language) set."""
    model = LanguageModel(dictionaries)
    encoders, langs, draw = model.encoders(), list(dictionaries), random.Random(7)
    each = max(4, CALIBRATE_ROWS // max(1, len(langs)))
    rows = [(lang, form, _scrambled(form, draw)) for lang in langs for form in held.get(lang, [])[:each]]
    for low, length in zip((0, *LENGTHS), LENGTHS, strict=False):
        own: dict[str, list[float]] = {lang: [] for lang in langs}
        wrong: dict[str, list[float]] = {lang: [] for lang in langs}
        for lang, form, junk in rows:
            part, scrap = _cut(form, length), _cut(junk, length)
            if len(part) <= low:
                continue
            at, bare, bare_scrap = langs.index(lang), encoders.size(part, None), encoders.size(scrap, None)
            own[lang].append(1 - encoders.size(part, lang) / bare)
            wrong[lang].append(1 - encoders.size(scrap, lang) / bare_scrap)
            for other in (langs[at + 1:] + langs[:at])[:AGAINST]:
                wrong[other].append(1 - encoders.size(part, other) / bare)
        for lang in langs:
            if own[lang]:
                least = float(np.quantile(own[lang], LOW)) if len(own[lang]) >= FEW_ROWS else min(own[lang]) / 2
                model.floors.setdefault(lang, []).append((length, min(least, (least + float(np.quantile(wrong[lang], HIGH))) / 2)))
    return model


def train(labelled: DataFrame, key: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Dictionaries from whole rows with a text and a language, in the order of a hash until they are full, and their calibration.

    Rows are chosen from a bounded sample of each language (``SAMPLE_ROWS``; of more than ``common.MAX_CLASSES`` languages
    the commonest). Of a text longer than a dictionary the part that one can hold is read. Without such rows there is no
    language, and everything is ``und``.
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("which"),
        F.least(F.length(text_col), F.lit(DICTIONARY_BYTES)).alias("size"), F.substring(text_col, 1, DICTIONARY_BYTES).alias("text"))
    sample, frequent = bounded_sample(rows.select("key", "lang", "which", "size"), "lang", "key", SAMPLE_ROWS)
    chosen, filled, place = [], dict.fromkeys(frequent, 0), dict.fromkeys(frequent, 0)
    for r in sample:  # in the order of the draws, per language
        lang, turn = r["lang"], place[r["lang"]]
        place[lang] += 1
        holds = turn % HELD_OUT == HELD_OUT - 1
        if not holds and filled[lang] >= 2 * DICTIONARY_BYTES:  # a form may be shorter than its text
            continue
        filled[lang] += 0 if holds else r["size"]
        chosen.append((r["key"], lang, r["which"], len(chosen), holds))
    if not chosen:
        return LanguageModel({})
    kind = rows.schema["key"].dataType.simpleString()
    wanted = F.broadcast(spark.createDataFrame(chosen, f"k {kind}, l string, w long, turn int, holds boolean"))  # bounded by the sample
    size = F.when(F.col("holds"), 4 * LENGTHS[-1]).otherwise(DICTIONARY_BYTES)
    found = rows.join(wanted, F.col("key").eqNullSafe(F.col("k")) & (F.col("lang") == F.col("l")) & (F.col("which") == F.col("w"))).groupBy("turn").agg(
        F.min(F.struct("lang", "holds", F.substr("text", F.lit(1), size).alias("text"))).alias("r")).select("turn", "r.*").orderBy("turn").collect()
    parts: dict[str, list[bytes]] = {}
    held: dict[str, list[bytes]] = {}
    for r in found:
        form = normal_form(r["text"])
        into = (held if r["holds"] else parts).setdefault(r["lang"], [])
        if form and form not in into:
            into.append(form)
    order = sorted(parts, key=lambda k: (-frequent[k], k))
    dictionaries = {k: b"".join(parts[k])[:DICTIONARY_BYTES] for k in order if parts[k]}
    # a copy or a near copy of a dictionary's row would calibrate on itself: its own part is not counted
    held = {k: [f for f in forms if _cut(f, 256) not in dictionaries.get(k, b"")] for k, forms in held.items()}
    return calibrated(dictionaries, held)


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, lang_pred, score, margin, rejected of every whole text.

    ``und`` (score 0, rejected) if the text is null or has no letter. Rejected too if the
    margin, in bytes and negative where nothing is saved, is less than ``MIN_MARGIN``. One
    row per input row, repeated ones included; only the key and the text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = model.encoders()
        for batch in batches:
            found = [decide(t.as_py(), encoders) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.int64()), pa.array([f[0] == UNKNOWN or f[2] < MIN_MARGIN for f in found], pa.bool_())],
                ["key", "lang_pred", "score", "margin", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(key, text_col).mapInArrow(run, f"key {kind}, lang_pred string, score double, margin long, rejected boolean")
            .withColumnRenamed("key", key))


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that are not rejected, with all their columns, ``lang_col`` set to the language found."""
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = model.encoders()
        for batch in batches:
            found = [decide(t.as_py(), encoders) for t in batch.column(at)]
            batch = batch.set_column(lang_at, batch.schema.field(lang_at).name, pa.array([f[0] for f in found], pa.string()))
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[2] >= MIN_MARGIN for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The fold that languages are learned from: crc32 of the id as text, mod 3, is not 1."""
    return docs.filter(crc_bucket("doc_id", 3) != 1)
