"""Language-model scores, packing, page extraction and the pipeline."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from panelyx.llm import gru, html_extraction, lm_scoring, packing

from .helpers import CLASHES, awkward_rows, empty, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_lm_base_scores_equal_brute_force(spark):
    rows = [*awkward_rows(), *((200 + i, " ".join(words(60, i))) for i in range(40))]
    out = lm_scoring.scored(frame(spark, rows, CLASHES), head=50, vocabulary=20, rounds=1).collect()
    tokens = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in rows:
        w = tokens(t)
        want[(i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in out)
    same = defaultdict(set)
    for r in out:
        same[r.doc_id].add(r.score)
    assert max(same[1]) - min(same[1]) < 1e-3  # repeated rows score alike, but for single-precision sums
    assert lm_scoring.scored(empty(spark), rounds=1).count() == 0


def test_lm_beats_unigrams_on_structured_text(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        a = "abcdef" if i % 2 else "uvwxyz"
        rows.append((i, " ".join(a[(k + int(rng.integers(2))) % 6] for k in range(80))))
    out = [r for r in lm_scoring.scored(frame(spark, rows)).collect() if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_trains_once_on_every_training_document(spark, monkeypatch):
    """Whole texts of all training rows reach the network, at any number of documents."""
    rows = [*awkward_rows(), *((200 + i, " ".join(words(3, i))) for i in range(2_000))]
    training = lm_scoring._training(frame(spark, rows, CLASHES), 7, 2).coalesce(1)
    head = lm_scoring.head_of(lm_scoring.token_counts(training), 500, 50)
    seen = []

    def to_pandas(self, take=type(training).toPandas):
        out = take(self)
        if "seen" in out.columns:
            seen.append(int(out["seen"].iloc[0]))
        return out

    monkeypatch.setattr(type(training), "toPandas", to_pandas)
    lm_scoring.trained(training, head)
    assert len(seen) == 2 and min(seen) > 0 and sum(seen) == head.tokens


def test_gru_is_a_distribution_and_gradients_are_right():
    m = gru.Model(np.array([50.0, 30, 20, 10, 5, 1]), hidden=4, classes=3)
    states = np.random.default_rng(0).normal(0, 1, (5, 4)).astype(np.float32)
    total = sum(np.exp(gru.log_probability(m, states, np.full(5, k))) for k in range(6))
    assert np.allclose(total, 1, atol=1e-5)
    texts = [np.array([0, 1, 2, 3, 0, 5]), np.array([4, 4, 0]), np.array([1])]
    one_by_one = [gru.score(m, [t])[0] for t in texts]
    assert np.allclose(gru.score(m, texts), one_by_one, atol=1e-4)
    assert np.allclose(gru.score(m, texts, cells=4), one_by_one, atol=1e-4)  # state is carried over window ends
    before = gru.score(m, texts).sum()
    for _ in range(30):
        gru.train(m, texts, rate=0.02, window=2, updates=1)
    assert gru.score(m, texts).sum() > before


def test_gradients_equal_finite_differences():
    m = gru.Model(np.array([50.0, 30, 20, 10, 5, 1]), hidden=4, classes=3)
    for n in m.names:
        setattr(m, n, getattr(m, n).astype(np.float64))
    texts = [np.array([0, 1, 2, 3, 0, 5, 1, 1]), np.array([4, 4, 0]), np.array([1]), np.array([2, 5, 3, 0])]
    ids, starts, running = gru.lanes_of(texts, 2, 5)
    assert int(running.sum()) == sum(map(len, texts)) and int(starts.sum()) == 5
    first = np.random.default_rng(2).normal(0, 0.5, (2, 4))
    _, found = gru.gradients(m, ids, starts, running, first.copy())
    for n in m.names:
        x = getattr(m, n).reshape(-1)
        for at in np.random.default_rng(3).choice(x.size, min(6, x.size), replace=False):
            old, loss = x[at], []
            for step in (1e-5, -1e-5):
                x[at] = old + step
                loss.append(gru.gradients(m, ids, starts, running, first.copy())[0])
            x[at] = old
            assert abs((loss[0] - loss[1]) / 2e-5 - found[n].reshape(-1)[at]) < 1e-6, n


def test_lanes_hold_every_token_once_and_score_agrees_with_the_loss():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 6, n) for n in (40, 3, 17, 1, 9, 9)]
    ids, starts, running = gru.lanes_of(texts, 4, 100)
    m = gru.Model(np.array([50.0, 30, 20, 10, 5, 1]), hidden=4, classes=3)
    loss, _ = gru.gradients(m, ids, starts, running, np.zeros((4, 4), np.float32))
    assert abs(loss * sum(map(len, texts)) + gru.score(m, texts).sum()) < 1e-2


@pytest.mark.parametrize("part_rows", [50_000, 40])
def test_packing(spark, part_rows):
    rows = [*awkward_rows(), *((300 + i, " ".join(words(50 + 13 * (i % 90), i))) for i in range(150))]
    cut_up = packing.pieces(frame(spark, rows, CLASHES), capacity=1024)
    out = packing.pack(cut_up, capacity=1024, part_rows=part_rows).toPandas()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for i, text in rows:
        ids = np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 1024)):
            want[(-1 if i is None else i, k, at, len(ids[at : at + 1024]), zlib.crc32(ids[at : at + 1024].tobytes()))] += 1
    assert Counter(zip(out.doc_id.fillna(-1).astype(int), out.piece, out.start, out.length, out.ids_crc32, strict=True)) == want
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.concatenate([[0], s.length.cumsum().to_numpy()[:-1]])).all() and s.length.sum() <= 1024
    sizes, counts = np.unique(out.length, return_counts=True)
    assert out.sequence_id.nunique() <= packing.lower_bound(sizes, counts, 1024) + (1 if part_rows > 1000 else 3)
    assert packing.packed_documents(empty(spark)).count() == 0


SPECIAL = ["<|endoftext|>", "a<|endoftext|>b", "x <|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "\u00e9<|endoftext|>e\u0301 <|startoftext|><|endoftext|>"]


def test_word_cache_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    cache = packing.WordIds(packing.tokenizer_path(), limit=3)  # a small limit turns the generations over
    assert cache.known
    texts = ["\u0130stanbul \u0391\u03a3 \u00e9 e\u0301 don't I'LL 1234 x\u00b2\u00bd", "a\x1cb c\x1f d", "\u65e5\u672c\u8a9e \u30c6\u30b9\u30c8 \ud55c\uad6d \ufb01 \u0149 \u017f \xada\xa0b\x85c", "THE The the!!! ...", "", " \n ", *SPECIAL]
    rng = np.random.default_rng(3)
    parts = [*"aB1!'\u00e9\u00df\u0130\u01c5 \n", "'ll", "<|", "|>", "endoftext", "<|endoftext|>", "<|startoftext|>", "\u0301", "\u65e5"]
    texts += ["".join(rng.choice(parts, 12)) for _ in range(3_000)]
    for text in texts:
        assert cache.ids(text) == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_another_tokenizer_file_is_asked_itself(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(packing.tokenizer_path(), encoding="utf-8") as f:
        file = json.load(f)
    file["normalizer"] = {"type": "NFC"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file), encoding="utf-8")
    cache = packing.WordIds(str(path))
    assert not cache.known
    for text in ["Upper Case  two spaces", *SPECIAL]:
        assert cache.ids(text) == np.asarray(Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_what_a_partition_keeps_is_certified():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = rng.integers(20, 60, 200)
        bins, _, fills = packing.best_fit_decreasing(sizes, 100)
        given = packing.given_up(sizes, fills, 100)
        bound = packing.lower_bound(*np.unique(sizes, return_counts=True), 100)
        if len(fills) > bound:
            kept = sizes[~given[bins]]
            assert int((~given).sum()) == -(-int(kept.sum()) // 100)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(1, 101, 60)
        fills = packing.best_fit_decreasing(sizes, 100)[2]
        assert packing.lower_bound(*np.unique(sizes, return_counts=True), 100) <= len(fills)
    assert packing.lower_bound(np.array([51]), np.array([7]), 100) == 7
    assert packing.lower_bound(np.array([34]), np.array([6]), 100) == 3


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body><nav><ul><li>Home<li>About</ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header><p>First   para&nbsp;graph <b>bold<br>next<p>Second<ul><li>one<li>two</ul>
<div class="comments">reader says</div></article><aside>Side</aside><form>Name</form><footer>&copy; site</footer></body></html>"""


def pages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "host", "path"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_article_text(spark):
    rows = [(1, "http://a.com/x", PAGE), (2, "http://a.com/y", PAGE.replace("Second", "Other")), (3, None, None), (4, "no url", ""), (5, "http://b.com/", "just text"), (1, "http://a.com/x", PAGE)]
    out = html_extraction.extract(pages(spark, rows)).collect()
    text = {r.page_id: r.text for r in out}
    assert text[1] == "Title & more\nFirst para graph bold next\nSecond\none\ntwo"
    assert text[2] == text[1].replace("Second", "Other")
    assert (text[3], text[4], text[5]) == ("", "", "just text") and len(out) == 6
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_extraction.extract(pages(spark, [])).count() == 0


def test_differencing_finds_furniture_without_names(spark):
    page = lambda body: f"<body><div>Our site<div>Read us daily</div>{body}<div>Imprint of the site</div></body>"
    rows = [(k, f"http://c.com/{k}", page(f"<p>Story number {k} tells something of its own at length, {'so ' * 20 + str(k)}</p>")) for k in range(3)]
    rows.append((9, "http://c.com/2", rows[2][2]))  # a copy of page 2 must not erase it
    out = {r.page_id: r for r in html_extraction.extract(pages(spark, rows).coalesce(1)).collect()}
    assert all(re.fullmatch(rf"Story number {k} [^\n]*", out[k].text) for k in (0, 1))
    assert "Story number 2" in out[9].text
    assert out[0].n_shared_lines == 3


def test_articles_inside_furniture_are_not_the_pages_article(spark):
    cards = "<aside><article><h3>Teaser</h3><p>of another page</p></article></aside><section class='comments'><article><p>reader says</p></article></section>"
    rows = [(1, "http://d.com/1", f"<body><div><p>The body of the page</p><section><p>goes on</p></section></div>{cards}</body>"), (2, "http://e.com/1", f"<body><p>loose</p><article><p>The article</p>{cards}</article></body>")]
    text = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    assert text == {1: "The body of the page\ngoes on", 2: "The article"}


def test_differencing_acts_inside_articles(spark):
    body = lambda k: f"<p>Story number {k} tells something of its own at length, {'so ' * 20 + str(k)}</p>"
    page = lambda k, more="": f"<body><article>{body(k)}{more}<p>Read on with a subscription</p></article></body>"
    rows = [(k, f"http://c.com/{k}", page(k)) for k in range(4)]
    rows += [(9, "http://c.com/3", rows[3][2])]  # a copy of page 3: neither erases the other
    quote = "<p>A passage that one other page quotes</p>"
    rows += [(20, "http://d.com/0", page(20, quote)), (21, "http://d.com/1", page(21, quote)), (22, "http://d.com/1", page(21, quote))]
    out = {r.page_id: r for r in html_extraction.extract(pages(spark, rows).coalesce(1)).collect()}
    assert all(re.fullmatch(rf"Story number {3 if k == 9 else k} [^\n]*", out[k].text) and out[k].n_shared_lines == 1 for k in (0, 1, 2, 3, 9))
    assert out[20].text.split("\n")[1:] == ["A passage that one other page quotes", "Read on with a subscription"]


def test_prose_that_articles_share_stays(spark):
    """Sentences that many articles of a host quote, at other places or with other neighbours, and headings that all have, are lost on no page."""
    import random

    rng = random.Random(4)
    quotes = [f"A sentence number {q} that a good many of the articles quote." for q in range(6)]
    rows, want = [], {}
    for k in range(60):
        own = [f"Sentence {i} of story {k} says {' '.join(str(rng.randrange(99)) for _ in range(6))}." for i in range(6)] + [q for q in quotes if rng.random() < 0.25]
        rng.shuffle(own)
        want[k] = "\n".join(["The week in the village", *own])
        # what the host sets into every article has no telling name: only alignment finds it
        set_in = "<div class='x1'><p>Read the whole paper for a small sum</p></div>"
        middle = len(own) // 2
        rows.append((k, f"http://g.com/{k:03}", "<body><div class='y7'><p>Village paper</p></div><article><h2>The week in the village</h2>" + "".join(f"<p>{x}</p>" for x in own[:middle]) + "".join(f"<p>{x}</p>" for x in own[middle:]) + set_in + "</article><div class='z3'><p>All rights with the paper</p></div></body>"))
    out = {r.page_id: r.text for r in html_extraction.extract(pages(spark, rows)).collect()}
    lost = {k: [x for x in want[k].split("\n") if x not in out[k].split("\n")] for k in want}
    assert not any(lost.values()), {k: v for k, v in lost.items() if v}
    assert out == want


def test_headings_and_legal_passages_of_an_article_stay(spark):
    rows = [(1, "http://f.com/1", "<main><div class='header'>Head</div><article><div class='legal'><p>Legal news body</p></div><div class='ad'>Buy</div><p class='notice'>Mind it</p></article></main><div class='legal'>Imprint</div>")]
    assert html_extraction.extract(pages(spark, rows)).first().text == "Head\nLegal news body"


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_every_page_meets_the_same_neighbours_in_any_number_of_ranges(spark, partitions):
    body = lambda k: f"<p>Story number {k} tells something of its own at length, {'so ' * 20 + str(k)}</p>"
    rows = [(h * 100 + k, f"http://h{h}.com/{k:03}", f"<body><article>{body(h * 100 + k)}<p>Line {h} of {k // 4}</p><p>Part {h} of {k // 20}</p></article><div>Imprint {h} {k // 2}</div></body>") for h in range(2) for k in range(40)]
    want = {}
    lines = {i: html_extraction.lines_of(x) for i, _, x in rows}
    for i, _, _ in rows:
        ring = [[lines[j] for j in (i - d, i + d) if j in lines] for d in range(1, 4)]
        want[i] = html_extraction.main_text(lines[i], ring[0], [x for r in ring[1:] for x in r])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.page_id: (r.text, r.n_shared_lines) for r in html_extraction.extract(pages(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want
    # without neighbours most texts are other ones
    assert sum(html_extraction.main_text(lines[i], [])[0] != got[i][0] for i in lines) > 0.5 * len(lines)


def test_long_and_deep_pages_take_seconds():
    import time

    start = time.time()
    a, b = ["same"] * 60_000, ["same"] * 60_000
    a[0], b[0], a[-1], b[-1] = "a", "b", "c", "d"
    assert len(html_extraction.common_lines(a, b)) == 59_998
    assert len(html_extraction.lines_of("<div>" * 30_000 + "<p>text" + "</div>" * 30_000)) == 1
    assert len(html_extraction.lines_of("<p>" + "<div>" * 20_000 + "x</p>" * 20_000)) == 20_000
    assert time.time() - start < 20


@pytest.mark.parametrize("pairs", [10**6, 0])
def test_common_lines_is_a_longest_common_subsequence(pairs):
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = ([f"l{x}" for x in rng.integers(0, 5, rng.integers(0, 14))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        kept = sorted(html_extraction.common_lines(a, b, pairs))
        assert len(kept) == table[-1, -1]
        it = iter(b)
        assert all(a[i] in it for i in kept)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "MinHash near-dedup"
    ids = set()
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert 0.5 * n < len(ids) < n
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= ids


def test_pipeline_takes_out_near_copies_from_80_percent_on(spark, sf_dir):
    base = [f"w{i}" for i in range(104)]
    changed = lambda at: " ".join("new" if i in at else w for i, w in enumerate(base))
    # 100 shingles each; k changed ones in either: Jaccard (100 - k) / (100 + k)
    rows = [(1, " ".join(base)), (2, changed({20, 60})), (3, " ".join(f"v{i}" for i in range(104))), (4, " ".join("new" if i in (20, 60, 90) else f"v{i}" for i in range(104)))]
    out = corpus_pipeline.near(spark, frame(spark, rows), sf_dir)
    assert {r.doc_id for r in out.select("doc_id").collect()} == {1, 3, 4}  # 90/110 = 0.82 goes, 85/115 = 0.74 stays
