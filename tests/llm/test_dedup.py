"""Exact, near and substring deduplication against brute force."""

import hashlib
import pickle
import re
from collections import Counter

import numpy as np
import pytest

from panelyx.llm import exact_dedup, near_dedup, substring_dedup
from panelyx.llm.components import components

from .helpers import CLASHES, awkward_rows, empty, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_groups(spark):
    rows = awkward_rows()
    got = Counter(tuple(r) for r in exact_dedup.exact_groups(frame(spark, rows, CLASHES)).collect())
    squeeze = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(squeeze(t), []).append((-len(t or ""), i is None, i))
    want = Counter()
    for i, t in rows:
        g = groups[squeeze(t)]
        keep = min(g)[2]
        want[(i, keep, len(g), i == keep, hashlib.sha256(squeeze(t).encode()).hexdigest())] += 1
    assert got == want


def test_exact_deduplicate_keeps_columns_and_one_row_of_each_text(spark):
    df = frame(spark, awkward_rows(), CLASHES)
    out = exact_dedup.deduplicate(df)
    assert out.columns == df.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in awkward_rows()})
    assert exact_dedup.exact_groups(empty(spark)).count() == 0 and exact_dedup.deduplicate(empty(spark)).count() == 0


def test_exact_deduplicate_keeps_the_winners(spark):
    rows = [(None, "a b"), (None, "ab"), (3, "ab "), (3, "ab "), (None, "zz"), (None, "z z"), (0, "yy"), (None, "y\ty"), (7, None), (8, "")]
    out = exact_dedup.deduplicate(frame(spark, rows, ["__own_row_id", "__w_id", "__exact_dedup_digest"]))
    assert out.columns[-3:] == ["__own_row_id", "__w_id", "__exact_dedup_digest"]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, [(3, "ab "), (None, "z z"), (None, "y\ty"), (7, None)]))


def test_exact_deduplicate_shuffles_whole_rows_once(spark):
    docs = frame(spark, awkward_rows())
    plan = exact_dedup.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    top = plan.index("Exchange")
    assert plan[:top].count("SortMergeJoin") + plan[:top].count("ShuffledHashJoin") + plan[:top].count("BroadcastHashJoin") == 1


def brute_components(rows, percent=85):
    def shingles(t):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = {i: shingles(t) for i, t in rows if i is not None}
    near = {i: i for i in sets}

    def root(i):
        while near[i] != i:
            i = near[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                near[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def hub_rows(n=140, seed=5):
    """Near copies of one text at all distances: some are linked with the hub, some only with each other."""
    rng = np.random.default_rng(seed)
    base = words(150, 9)
    rows, texts = [], [base]
    for i in range(n):
        t = list(texts[rng.integers(len(texts))] if i % 3 else base)
        for _ in range(int(rng.integers(1, 5))):
            t[int(rng.integers(len(t)))] = f"n{rng.integers(10_000)}"
        texts.append(t)
        rows.append((100 + i, " ".join(t)))
    return rows


@pytest.mark.parametrize("rows", [awkward_rows(), hub_rows()], ids=["awkward", "hub"])
def test_near_groups_equal_brute_force(spark, rows):
    want = brute_components(rows)
    for r in near_dedup.near_groups(frame(spark, rows, CLASHES)).collect():
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], r.doc_id == want[r.doc_id][1])


def test_near_deduplicate(spark):
    df = frame(spark, awkward_rows(), CLASHES)
    out = near_dedup.deduplicate(df)
    assert out.columns == df.columns
    assert {2, 3, 4, 10}.isdisjoint(r.doc_id for r in out.select("doc_id").collect())
    assert near_dedup.near_groups(empty(spark)).count() == 0


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    share = (near_dedup.registers(np.unique(a)) == near_dedup.registers(np.unique(b))).mean()
    assert abs(share - 1800 / 2200) < 0.12


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)]
    out = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(out[i] == 1 for i in range(1, 41)) and all(out[i] == 100 for i in range(101, 140))


def brute_substrings(rows):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    for i, w in split:
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            if g not in first or order(i) < order(first[g]):
                first[g] = i
    out = Counter()
    for i, w in split:
        lost = set()
        for k in range(len(w) - 12):
            if order(first[tuple(w[k : k + 13])]) < order(i):
                lost |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in lost)
        out[(i, len(w), len(lost), kept)] += 1
    return out


def passages(seed=3):
    shared = [words(40, 70 + k) for k in range(3)]
    rows = []
    for i in range(60):
        t = words(30, 1000 + i) + shared[i % 3] + words(20, 2000 + i)
        if i % 7 == 0:
            t += ["der"] * 60
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("rows", [awkward_rows(), hub_rows(60), passages()], ids=["awkward", "hub", "passages"])
@pytest.mark.parametrize("hot", [2, 500])
def test_substrings_equal_brute_force(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup.filter_of, "__defaults__", (hot,))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in substring_dedup.deduplicate(frame(spark, rows, CLASHES)).collect())
    assert got == brute_substrings(rows)


@pytest.mark.parametrize("bits", [6, 10])
def test_substrings_with_a_tiny_table_of_touched_documents_and_a_tiny_filter(spark, bits, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", (6, bits))
    rows = passages()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in substring_dedup.deduplicate(frame(spark, rows), touched_bits=bits).collect())
    assert got == brute_substrings(rows)


def test_tables_of_substrings_do_not_grow_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", (18, 18))
    docs = spark.range(8_000).selectExpr("id AS doc_id", "id AS digest", "array(xxhash64(id % 4000), xxhash64(id, 1)) AS least")
    known = substring_dedup.filter_of(docs, 8_000, 500)
    assert len(pickle.dumps(known)) < 1_000  # the two tables have 64 KB
    repeated = np.array([r.m for r in spark.range(4_000).selectExpr("xxhash64(id) AS m").collect()], np.int64).view(np.uint64)
    assert known.holds(known.repeated, repeated).all() and not known.holds(known.hot, repeated).any()
    marked = substring_dedup._marked(docs.select("doc_id"), docs.select("doc_id").filter("doc_id % 3 = 0"), 18)
    assert {r.doc_id for r in marked.filter("touched").collect()} >= set(range(0, 8_000, 3)) and marked.filter("not touched").count() > 5_000

    def broadcast_rows(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return broadcast_rows(plan.executedPlan())
        if plan.nodeName().endswith("QueryStage"):
            return broadcast_rows(plan.plan())
        own = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "BroadcastExchange" else 0
        return own + sum(broadcast_rows(plan.children().apply(i)) for i in range(plan.children().size()))

    plan = marked._jdf.queryExecution().executedPlan()
    plan.execute().count()
    assert broadcast_rows(plan) == 4  # pages of 1,024 words, not 4,096 words


def test_substrings_of_an_empty_table(spark):
    assert substring_dedup.deduplicate(empty(spark)).count() == 0


def test_fm_index_counts():
    rng = np.random.default_rng(4)
    texts = [[b"w%d" % x for x in rng.integers(0, 6, n)] for n in (30, 17, 45)]
    index = substring_dedup.FmIndex(texts)
    for t, start in zip(texts, index.starts, strict=True):
        ends = np.arange(start + 3, start + len(t))
        low, high = index.intervals(ends, 4)
        for e, a, b in zip(ends - start, low, high, strict=True):
            pattern = t[e - 3 : e + 1]
            assert b - a == sum(s[k : k + 4] == pattern for s in texts for k in range(len(s) - 3))
