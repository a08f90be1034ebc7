"""Exact dedup, near-dedup, mixing and the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from settlekit.llm import components, digest_index, minmax, mixing
from settlekit.llm.common import table
from edge_rows import EDGES, frame


# ---- op4 -------------------------------------------------------------------
def test_exact_dedup_edges(spark, edges, nothing):
    got = {(r.doc_id, r.text_sha256): r for r in digest_index.exact_dedup(edges).collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    distinct = {(i, t or "") for i, t in EDGES}
    assert set(got) == {(i, sha(t)) for i, t in distinct}
    for i, t in distinct:
        same = [j for j, u in distinct if u == t]
        keep = max((j for j in same if j is not None), default=None)
        r = got[i, sha(t)]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(same), i == keep)
    assert got[7, sha("Repeated row.")].copies == 2
    assert digest_index.exact_dedup(nothing).count() == 0
    kept = digest_index.keep_first(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in {r.doc_id for r in got.values() if r.kept})


def test_index_persists_and_is_anti_joined(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    first = frame(spark, [(1, "a"), (2, "b"), (3, "b")])
    digest_index.exact_dedup(first, digest_index.DigestIndex(spark, path, 4)).collect()
    reopened = digest_index.DigestIndex(spark, path, 4)
    rows = {r.doc_id: r for r in digest_index.exact_dedup(frame(spark, [(9, "a"), (10, "c"), (11, "c")]), reopened).collect()}
    assert (rows[9].keep_id, rows[9].kept) == (1, False)
    assert (rows[10].keep_id, rows[10].kept, rows[11].kept) == (11, False, True)
    assert reopened.read().count() == 3
    reopened.append(reopened.read())  # a repeated job adds nothing
    assert reopened.read().count() == 3


def test_anti_join_is_sort_merge_and_leaves_the_index_where_it_is(spark, tmp_dir):
    index = digest_index.DigestIndex(spark, f"{tmp_dir}/plan", 8)
    digest_index.exact_dedup(frame(spark, [(1, "a")]), index).collect()
    groups = spark.createDataFrame([(b"x" * 32, 5)], "digest binary, keep_id long")
    plan = groups.join(index.read().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan


# ---- op6 -------------------------------------------------------------------
def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(*(w[k:] for k in range(words)))) if len(w) >= words else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def result(df, p):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minmax.near_duplicates(df, p).collect() if r.doc_id is not None}


@pytest.mark.parametrize("p", [minmax.MinMax(3, 85, 6, 32), minmax.MinMax()])
def test_near_duplicates_against_brute_force(spark, docs, p):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, p) == brute(rows, p.words, p.percent)


def drifting(groups=3, members=60):
    """Chains whose ends are not alike, and clusters around one text."""
    random.seed(11)
    word = lambda: f"w{random.randrange(10**6)}"
    rows = []
    for g in range(groups):
        base = [word() for _ in range(120)]
        for _ in range(members):
            if g % 2 == 0:
                base = list(base)
                base[random.randrange(120)] = word()
            text = list(base)
            for _ in range(random.randrange(7) if g % 2 else 0):
                text[random.randrange(120)] = word()
            rows.append(" ".join(text))
    random.shuffle(rows)
    return list(enumerate(rows))


def test_chains_and_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minmax, "BLOCK", 8)  # several blocks in a bucket
    rows = drifting()
    p = minmax.MinMax()
    got, want = result(frame(spark, rows), p), brute(rows, p.words, p.percent)
    assert got == want and len({v[1] for v in want.values()}) < 60


def test_repeated_rows_do_not_cancel_out(spark):
    random.seed(2)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(300):
        text = list(base)
        for at in random.sample(range(120), random.randrange(1, 8)):
            text[at] = f"w{random.randrange(10**6)}"
        texts.append(" ".join(text))
    rows = list(enumerate(texts))
    p = minmax.MinMax(3, 85, 6, 32)
    want = brute(rows, p.words, p.percent)
    assert result(frame(spark, rows * 2), p) == want and len({v[1] for v in want.values()}) > 1
    assert {r.copies for r in minmax.near_duplicates(frame(spark, rows * 2), p).collect()} == {2}


def test_near_duplicate_edges(spark, edges, nothing):
    p = minmax.MinMax(3, 85, 6, 32)
    rows = {r.doc_id: r for r in minmax.near_duplicates(edges, p).collect()}
    assert len(rows) == len({i for i, _ in EDGES})
    for i in (1, 2, 3):
        assert (rows[i].n_shingles, rows[i].component_id, rows[i].kept) == (0, i, True)
    assert (rows[6].component_id, rows[6].kept) == (5, False) and rows[7].copies == 2
    assert rows[None].component_id is None and rows[None].kept
    assert rows[10].n_shingles == 1
    assert minmax.near_duplicates(nothing, p).count() == 0
    kept = minmax.keep_representatives(edges, p)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, r in rows.items() if r.kept)


def test_min_max_is_an_unbiased_estimate():
    rng = np.random.default_rng(4)
    p = minmax.MinMax(rows=8, bands=256)
    signer = minmax.Signatures(p)
    x = rng.integers(0, 2**63, 300, np.uint64)
    a, b = x[:250], x[50:]
    same = signer.min_max(a) == signer.min_max(b)
    assert len(same) == 2 * p.permutations
    assert abs(same.mean() - 200 / 300) < 0.06


def test_components_against_brute_force(spark):
    random.seed(5)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(200)]
    root = {i: i for ab in links for i in ab}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.u: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root if find(i) != i}


# ---- op5 -------------------------------------------------------------------
def members(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(1, 500)), [float(x) for x in rng.dirichlet([0.3, 0.3, 0.3])]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>"), rows


def expected(rows, rates):
    t, p = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    return (t * rates) @ p


def test_rates_meet_the_targets(spark):
    df, rows = members(spark)
    for shares, total in (([0.2, 0.3, 0.5], None), ([0.9, 0.05, 0.05], 200_000.0), ([1.0, 1.0, 1.0], 1_000.0)):
        steps = mixing.fit_rates(df, shares, total)
        rates = np.array([r.r for r in df.withColumn("r", mixing.rate(steps)).orderBy("doc_id").collect()])
        have = expected(rows, rates)
        want = np.array(shares) / sum(shares)
        assert (rates >= 0).all() and np.allclose(have / have.sum(), want, atol=1e-5)
        if total:
            assert np.isclose(have.sum(), total, rtol=1e-5)


def test_bounded_rates_are_the_least_squares_optimum(spark):
    df, rows = members(spark, 60, 3)
    steps = mixing.fit_rates(df, [0.6, 0.3, 0.1], 14_000.0, most=1.0)
    rates = np.array([r.r for r in df.withColumn("r", mixing.rate(steps, 1.0)).orderBy("doc_id").collect()])
    assert ((rates >= 0) & (rates <= 1)).all()
    target = np.array([0.6, 0.3, 0.1]) * 14_000
    loss = lambda r: float(((expected(rows, r) - target) ** 2).sum())
    t, p = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    best = np.ones(60)  # plain projected gradient, many steps
    a = t[:, None] * p
    for _ in range(200_000):
        best = np.clip(best - (a @ (best @ a - target)) / np.linalg.norm(a) ** 2, 0, 1)
    assert loss(rates) <= loss(best) + 1e-3 * (target**2).sum()


@pytest.mark.parametrize("shares,total,most", [([0.6, 0.3, 0.1], 14_000.0, 1.0), ([0.1, 0.1, 0.8], None, 1.0), ([0.2, 0.2, 0.6], 60_000.0, 1.5), ([0.9, 0.05, 0.05], 9_000.0, None)])
def test_fit_ends_at_the_optimum_and_says_what_it_reached(spark, shares, total, most):
    df, rows = members(spark, 60, 3)
    fit = mixing.fit(df, shares, total, most)
    rates = np.array([r.r for r in df.withColumn("r", mixing.rate(fit.steps, most)).orderBy("doc_id").collect()])
    t, p, target = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows]), np.array(fit.target)
    a, best, at, age = t[:, None] * p, np.ones(60), np.ones(60), 1.0
    for _ in range(100_000):  # accelerated projected gradient on the rates themselves
        new = np.clip(at - (a @ (at @ a - target)) / np.linalg.norm(a, 2) ** 2, 0, np.inf if most is None else most)
        grown = (1 + np.sqrt(1 + 4 * age * age)) / 2
        at, best, age = new + (age - 1) / grown * (new - best), new, grown
    miss = lambda r: float(np.linalg.norm(r @ a - target))
    assert fit.settled and fit.rounds < 100 and np.allclose(fit.expected, rates @ a, rtol=1e-5)
    assert miss(rates) <= miss(best) + 1e-4 * target.sum() * (miss(best) > 1e-6 * target.sum()) + 1e-6 * target.sum()


def test_reachable_targets_of_a_small_table_are_met(spark, sf):
    docs, labelled = table(spark, sf, "documents"), mixing.label_domains(table(spark, sf, "labels"))
    rows = mixing.mix(docs, labelled).collect()
    want = np.array([mixing.TARGETS[d] for d in sorted(mixing.TARGETS)])
    have = np.array([np.array(r.posterior) * r.tokens * r.rate for r in rows]).sum(0)
    assert np.allclose(have / have.sum(), want, rtol=1e-4)
    assert all(float(x * mixing.GRID).is_integer() for r in rows for x in r.posterior)


def test_two_texts_under_one_id_are_dealt_by_themselves(spark):
    sf = "/root/testdata/sf0.01"
    docs, labelled = table(spark, sf, "documents"), mixing.label_domains(table(spark, sf, "labels"))
    good, toxic = (labelled.filter(F.col("domain") == d).select("doc_id").limit(20) for d in ("good", "toxic"))
    pair = docs.join(good, "doc_id").select(F.lit(-5).cast("long").alias("doc_id"), "text", "lang", "source", "n_chars").unionByName(
        docs.join(toxic, "doc_id").select(F.lit(-5).cast("long").alias("doc_id"), "text", "lang", "source", "n_chars"))
    both = docs.unionByName(pair.dropDuplicates(["text"]))
    rates = {r.digest: r.copies for r in mixing.mix(both, labelled, most=1.0, keep="good").filter("doc_id = -5").collect()}
    assert set(rates.values()) == {0, 1}
    kept = mixing.keep_mixed(both, labelled, most=1.0, keep="good").filter("doc_id = -5").select(F.md5(F.col("text").cast("binary"))).collect()
    assert sorted(r[0] for r in kept) == sorted(d for d, n in rates.items() if n)


def test_posteriors_on_the_grid_sum_to_one():
    rng = np.random.default_rng(1)
    for p in rng.dirichlet([0.3, 0.3, 0.3, 0.3], 500):
        q = mixing.on_grid(p)
        assert q.sum() == 1.0 and (q >= 0).all() and np.abs(q - p).max() <= 1 / mixing.GRID


def test_copies_follow_the_rates(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 * 0.5).alias("rate")).withColumn("copies", mixing.copies())
    for r in df.groupBy("rate").agg(F.avg("copies").alias("m"), F.min("copies").alias("lo"), F.max("copies").alias("hi")).collect():
        assert abs(r.m - r.rate) < 0.04 and r.lo >= int(r.rate) and r.hi <= int(r.rate) + 1


def test_mixing_learns_the_domains(spark):
    sf = "/root/testdata/sf0.01"
    docs, labelled = table(spark, sf, "documents"), mixing.label_domains(table(spark, sf, "labels"))
    rows = mixing.mix(docs, labelled).join(labelled, "doc_id").collect()
    names = sorted(mixing.TARGETS)
    assert np.mean([names[int(np.argmax(r.posterior))] == r.domain for r in rows]) > 0.95


def test_mixing_edges(spark, edges, nothing):
    labelled = spark.createDataFrame([(5, "good"), (7, "poor"), (None, "good"), (4, None)], "doc_id long, domain string")
    rows = mixing.mix(edges, labelled).collect()
    assert len(rows) == len(EDGES) and all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 for r in rows)
    assert [r.copies for r in rows if r.doc_id is None] == [1]
    assert mixing.mix(nothing, labelled).count() == 0
    assert mixing.keep_mixed(edges, labelled.limit(0)).columns == edges.columns
    assert sum(r.copies for r in rows) == mixing.keep_mixed(edges, labelled).count()


@pytest.mark.parametrize("few", [0, 6])
def test_clean_documents_stay_when_a_domain_is_scarce(spark, few):
    sf = "/root/testdata/sf0.01"
    labelled = mixing.label_domains(table(spark, sf, "labels"))
    toxic = [r.doc_id for r in labelled.filter("domain = 'toxic'").orderBy("doc_id").collect()][few:]
    docs, labelled = (df.filter(~F.col("doc_id").isin(toxic)) for df in (table(spark, sf, "documents"), labelled))
    rows = mixing.mix(docs, labelled, most=1.0, keep="good").join(labelled, "doc_id").collect()
    kept = {d: [r.tokens * r.copies for r in rows if r.domain == d] for d in mixing.TARGETS}
    assert np.mean([r.copies for r in rows if r.domain == "good"]) > 0.95
    assert sum(kept["poor"]) < 0.07 * sum(map(sum, kept.values()))


def test_kept_domain_sets_the_total(spark):
    rows = [(i, 100, [0.98, 0.01, 0.01]) for i in range(90)] + [(90 + i, 100, [0.01, 0.98, 0.01]) for i in range(30)] + [(120, 10, [0.01, 0.01, 0.98])]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>")
    steps = mixing.fit_rates(df, [0.94, 0.04, 0.02], most=1.0, keep=0)
    rates = np.array([r.r for r in df.withColumn("r", mixing.rate(steps, 1.0)).orderBy("doc_id").collect()])
    assert rates[:90].min() > 0.95 and rates[90:120].max() < 0.2 and rates[120] > 0.9


def test_without_a_label_of_the_kept_domain_all_stay(spark, docs):
    labelled = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "poor").otherwise("toxic").alias("domain"))
    for labels in (labelled, labelled.limit(0)):
        assert mixing.keep_mixed(docs, labels, most=1.0, keep="good").count() == docs.count()


# ---- pipeline --------------------------------------------------------------
def test_pipeline_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    staged = docs
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in staged.collect()}
        staged = stage(spark, staged, sf)
        assert staged.columns == docs.columns
        staged = staged.cache()
        texts[name] = {r.doc_id: r.text for r in staged.collect()}
        assert texts[name].items() <= before.items() and staged.count() == len(texts[name])
    seen = texts["language_id"]
    last = {}
    for i, t in seen.items():
        last[t] = max(last.get(t, i), i)
    assert set(texts["exact_dedup"]) == set(last.values())
    groups = brute(list(texts["exact_dedup"].items()), 5, 80)
    assert set(texts["near_dedup"]) == {i for i, v in groups.items() if v[2]}
    assert len(seen) > 0.98 * docs.count() and len(texts["mix_sources"]) > 0.6 * len(texts["near_dedup"])
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(final) == set(texts["mix_sources"])
    for i, r in final.items():
        assert r.decoded_sha256 == hashlib.sha256(texts["mix_sources"][i].encode()).hexdigest() and len(r.token_ids) == r.n_tokens
