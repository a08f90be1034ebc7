"""Merkle manifest, spelling variants and chat formatting against plain forms of the same contracts."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from edge_rows import EDGES, frame
from pyspark.sql import functions as F

from settlekit.llm import chat, merkle, variants
from settlekit.llm.queries import BYTE_BPE


# ---- op11 ------------------------------------------------------------------
def hashed(*digests):
    return sha256("".join(digests).encode()).hexdigest()


def plain_leaf(*values):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_steps(levels, i):
    """Nodes beside the path as (left, right) texts."""
    found = []
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        found.append(("".join(run[:i % 2]), "".join(run[i % 2 + 1:])))
        i //= 2
    return found


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) for rows of doc_id, text, lang, source, n_chars."""
    trees = {}
    for d, text, lang, source, n in rows:
        new = plain_leaf(d, source, lang, n if n is None else n + 1, text)
        trees.setdefault(lang, []).append((d is not None, d, plain_leaf(d, source, lang, n, text), new))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    levels = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
        levels[lang] = plain_tree([r[2] for r in trees[lang]])
    top = plain_tree([levels[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, (_, d, leaf, new) in enumerate(trees[lang]):
            steps = plain_steps(levels[lang], i) + plain_steps(top, k)
            folded = new if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else leaf
            for a, b in steps:
                folded = hashed(a, folded, b)
            out.append((d, leaf, levels[lang][-1][0], top[-1][0], hashed(*[a + b for a, b in steps]), folded, folded == top[-1][0]))
    return out


def in_any_order(rows):
    return sorted(rows, key=repr)


def manifest_rows(df, bits):
    return [tuple(r)[:7] for r in merkle.verify(df, bits).collect()]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_over_several_levels_of_blocks(spark, docs, bits):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [(10_000 + i, f"t{i}", None if i % 3 else "", None, None if i % 2 else i) for i in range(23)]
    rows += [(20_000, "é" * 9, "ä", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = manifest_rows(df, bits)
    assert in_any_order(found) == in_any_order(plain_manifest(rows))
    assert sum(not r[6] for r in found) > 20


def test_manifest_edges_and_nothing(spark, edges, nothing):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in EDGES]
    assert in_any_order(manifest_rows(edges, 2)) == in_any_order(plain_manifest(rows))
    assert merkle.verify(nothing).collect() == []
    huge = [(7, "x", None, None, 2**63 - 1), (21, "y", None, None, None), (25, None, None, None, None)]
    df = spark.createDataFrame(huge, "doc_id long, text string, lang string, source string, n_chars long")
    assert in_any_order(manifest_rows(df, 10)) == in_any_order(plain_manifest(huge))
    one = frame(spark, [(14, "alone")])
    assert in_any_order(manifest_rows(one, 10)) == in_any_order(plain_manifest([(14, "alone", "en", "s", 5)]))


def test_a_version_copies_only_ancestors(spark, docs):
    leaves = merkle.build(merkle.document_leaves(docs), 2).leaves.collect()
    assert all((r["copied"] is None) == (r["new"] is None) for r in leaves)
    assert all(len(r["copied"]) == len(r["steps"]) + 1 and r["copied"][0] == r["new"] for r in leaves if r["new"] is not None)
    tree = merkle.PersistentBlock([bytes([i]) * 32 for i in range(13)], 4)
    before, n = list(tree.digest), len(tree.digest)
    root, copied = tree.changed(12, b"x" * 32)
    assert tree.digest[:n] == before and len(tree.digest) == n + 5 == n + len(copied) and root == copied[-1]
    assert tree.changed(12, bytes([12]) * 32)[0] != root and tree.digest[-1] == tree.digest[tree.root]  # the first version again


def test_every_leaf_is_folded_over_its_own_proof(spark, monkeypatch):
    rows = [(i, f"t{i}", "en" if i % 2 else None, "s", i) for i in range(1, 20)]
    made = merkle.build(merkle.document_leaves(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")), 2)
    forged = F.transform("steps", lambda s, i: F.when(i == 0, F.struct(s["beside_left"].alias("beside_left"), F.unhex(F.lit("00" * 32)).alias("beside_right"))).otherwise(s))
    bad = made.leaves.withColumn("steps", F.when(F.col("key") == 1, forged).otherwise(F.col("steps"))).withColumn(
        "digest", F.when(F.col("key") == 4, F.unhex(F.lit("11" * 32))).otherwise(F.col("digest")))
    untampered = {r["key"] for r in made.leaves.filter("new IS NULL").select("key").collect()}
    assert {1, 4} <= untampered
    monkeypatch.setattr(merkle, "build", lambda *_: merkle.Manifest(bad, made.roots))
    found = {r["doc_id"]: r for r in merkle.verify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert {d for d, r in found.items() if r["verified"]} == untampered - {1, 4}
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in found.values())


# ---- op13 ------------------------------------------------------------------
CONV = "conv_id long, turn long, role string, text string"

ODD_TURNS = ["", "\\", "\\\\", "###", "\\###", "</turn>", "\\</turn>", "\n", "\n\n</turn>\n### assistant:\nx", "#" * 7, "</turn</turn>", "é😀 ünï\u0000 ﻿",
             "<|endoftext|>", " leading and trailing \n", "😀" * 50, "\\" * 1001 + "</turn>", "x" * 100_000, "word " * 20_000, chat.TRICKY, "</tur", "n>"]


def plain_chat(rows):
    """What the contract asks of the rows, without formatting; by conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for conv, turns in convs.items():
        turns = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), sha256(said.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest())
    return out


def chat_rows(df):
    return chat.format_conversations(df, BYTE_BPE)


def test_chat_reads_back_odd_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(ODD_TURNS)]
    rows += [(2, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(reversed(ODD_TURNS))]
    rows += [(3, 0, "assistant", None), (3, None, None, "no turn"), (3, 0, "a:\n\\###</turn>", "role"), (None, 0, "assistant", "no id"), (4, 1, "user", "tie"),
             (4, 1, "assistant", "tie"), (4, 1, "assistant", "tie")]
    rows += [(5 + i, 0, "assistant", t) for i, t in enumerate(ODD_TURNS)]
    df = spark.createDataFrame(rows, CONV)
    formatted = chat_rows(df).cache()
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(formatted).collect()}
    assert found == plain_chat(rows)
    for r in formatted.collect():
        assert len(r["input_ids"]) == len(r["token_start"]) == len(r["token_end"]) == len(r["loss_mask"])
        spans = [s for s in zip(r["turn_start"], r["turn_end"], r["turn_learned"], strict=True) if s[2]]
        tokens = list(zip(r["token_start"], r["token_end"], r["loss_mask"], strict=True))
        for a, b, m in tokens if len(tokens) < 2_000 else tokens[:500]:
            assert m == any(a < y and x < b for x, y, _ in spans)
    formatted.unpersist()


def test_chat_tokens_are_those_of_the_whole_text(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    t.encode_special_tokens = True
    rows = [(1, 0, "user", "What is <|endoftext|>?"), (1, 1, "assistant", "A name.")]
    (r,) = chat_rows(spark.createDataFrame(rows, CONV).withColumn("formatted", F.lit(1)).withColumn("turns", F.lit(2))).collect()
    assert r["formatted"] == "### user:\nWhat is <|endoftext|>?\n</turn>\n### assistant:\nA name.\n</turn>\n"
    assert r["input_ids"] == t.encode(r["formatted"], add_special_tokens=False).ids and 50256 not in r["input_ids"]
    assert t.decode([i for i, m in zip(r["input_ids"], r["loss_mask"], strict=True) if m]) == "A name."


def test_chat_of_nothing_and_of_the_table(spark, sf):
    assert chat.read_back(chat_rows(spark.createDataFrame([], CONV))).collect() == []
    table = chat.with_tricky(spark.read.parquet(f"{sf}/conversations.parquet"))
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(chat_rows(table)).collect()}
    assert found == plain_chat(rows) and -7 in found


def test_chat_parse_is_linear_and_refuses_other_text():
    long = "\\" * 1_000_000 + "</turn>" * 50_000
    assert chat.parse(chat.render([("user", long), ("assistant", "ok")])[0]) == [("user", long), ("assistant", "ok")]
    with pytest.raises(ValueError):
        chat.parse("hello")
    with pytest.raises(ValueError):
        chat.parse("### user:\nno end")


# ---- op12 ------------------------------------------------------------------
def plain_words(rows):
    """word -> n for (doc_id, text) rows."""
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] = counts.get(word, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def plain_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and is_near(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def variant_rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("cell", [4, 64, 8192])
def test_variants_of_made_words(spark, cell):
    rng = random.Random(cell)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcdeé×Ä") for _ in range(rng.randint(5, 9)))
        for _ in range(12):
            counts[word] = rng.choice([3, 3, 4, 6, 8, 16, 40, 100])
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice("abcdeéÿ")) + word[at + (kind != 2):]
            if len(word) < 5:
                break
    counts |= {"".join(p): 3 + i % 5 for i, p in enumerate(itertools.permutations("abcdef"))}  # one vector for 720 words
    counts |= {"abcdeg": 50, "abcde": 9, "x" * 300: 3, "x" * 299: 6, "x" * 200 + "y" + "x" * 99: 4, "y" * 130 + "x" * 170: 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert in_any_order(variant_rows(variants.group(df, cell=cell, sample=500))) == in_any_order(plain_variants(counts))


def test_variants_of_documents_edges_and_nothing(spark, docs, edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").limit(60).collect()]
    found = variants.spelling_variants(docs.join(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"), "doc_id"))
    assert in_any_order(variant_rows(found)) == in_any_order(plain_variants(plain_words(rows)))
    assert in_any_order(variant_rows(variants.spelling_variants(edges))) == in_any_order(plain_variants(plain_words(EDGES)))
    assert variants.spelling_variants(nothing).collect() == []


def test_variants_follow_long_chains(spark):
    steps = [("aaaaa" + "b" * i, 3 * 2 ** i) for i in range(20)]
    df = spark.createDataFrame(steps, "word string, n long")
    found = {r["word"]: r["root"] for r in variants.group(df).collect()}
    assert set(found.values()) == {steps[-1][0]}


def test_cells_hold_all_near_vectors():
    rng = np.random.default_rng(5)
    found = sorted({"".join(rng.choice(list("abcdefg"), 7)) for _ in range(3000)})
    v = variants.vectors(found)
    tree = variants.fit(v[::7], 7, 100)
    cells = variants.places(tree, v)
    assert len(set(cells.tolist())) > 10
    to = {}
    for row, cell in zip(*variants.reached(tree, v, 1), strict=True):
        to.setdefault(int(row), set()).add(int(cell))
    pairs = [(i, j) for i in range(0, len(found), 4) for j in range(len(found)) if is_near(found[i], found[j])]
    assert len(pairs) > 50 and all(int(cells[j]) in to[i] for i, j in pairs)
    assert np.mean([len(c) for c in to.values()]) < 0.7 * len(set(cells.tolist()))
