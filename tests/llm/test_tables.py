"""Source divergence, ball k-means and WARC archives, against plain loops."""

import gzip
import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelyx.llm import ball_kmeans, divergence, warc

from .helpers import CLASHES, awkward_rows, empty, frame

# --- divergence ---------------------------------------------------------------------------------------------------------


def plain_audit(rows, least, top):
    """rows: lang, source, text."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        share = lambda c, of=kept: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in of) + 5 * len(of)) for t in of}
        p = share(counts[lang, source])
        q = share(sum((counts[g] for g in groups if g[0] == lang), Counter()))
        pairs = {s: sum(abs(p[t] - o[t]) for t in kept) for (g, s) in groups if g == lang and s != source for o in [share(counts[g, s])]}
        terms = {t: p[t] - q[t] for t in kept if counts[lang, source][t] and p[t] > q[t]}
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            order = sorted(found, key=lambda t: (-found[t], t.encode()))[:most]
            out |= {(lang, source, part, t, found[t], i + 1) for i, t in enumerate(order)}
    return out


def audit_rows():
    rng = random.Random(5)
    vocabulary = [f"t{'abcdefghij'[i % 10]}{'xyz'[i // 10 % 3]}" for i in range(30)] + ["日本", "Ünï", "ünï", "Az", "AZ"]
    rows = [(rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "d", None, ""]), " ".join(rng.choices(vocabulary, k=rng.randrange(40)))) for _ in range(150)]
    rows += [("en", "silent", None), ("en", "silent", "123 !!"), ("fr", "only", "un deux"), ("xx", "p", "rare"), ("xx", "q", None)]
    return rows + rows[:5]


def audit_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "x") for i, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, term string")


@pytest.mark.parametrize("sizes", [{}, {"chunk": 3, "stripe": 2, "block": 2}, {"chunk": 1, "stripe": 1, "block": 1}])
def test_audit_equals_plain_loops(spark, sizes):
    rows = audit_rows()
    out = divergence.audit(audit_frame(spark, rows), least_docs=5, top_terms=7, **sizes).collect()
    assert {tuple(r) for r in out} == plain_audit(rows, 5, 7)
    assert len(out) == len({tuple(r) for r in out})


def test_audit_of_awkward_texts_and_of_nothing(spark):
    rows = awkward_rows()
    out = divergence.audit(frame(spark, rows, [c for c in CLASHES if c not in ("lang", "source")]), least_docs=2)
    assert {tuple(r) for r in out.collect()} == plain_audit([("en", "src0", t) for _, t in rows], 2, 50)
    assert divergence.audit(empty(spark)).collect() == []


def test_audit_without_shared_terms_has_pairs_of_zero(spark):
    out = divergence.audit(audit_frame(spark, [("en", "a", "x"), ("en", "b", None), ("en", "c", "y")])).collect()
    assert {(r.source, r.item, r.value, r.rank) for r in out} == {(a, b, 0, i) for a, o in (("a", "bc"), ("b", "ac"), ("c", "ab")) for i, b in enumerate(o, 1)}


def test_terms_across_slices(monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE", 7)
    for text in ("abc Def ghi'jklmnopqrstuvwxyz é日本 x", "a" * 50, "", "Äb " * 9, "1 2 3 4 5 6 7 8 9 z"):
        low = "".join(c.lower() if c.isascii() else c for c in text)
        want = [t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)]
        assert [t for part in divergence.terms_of(text.encode()) for t in part] == want


def test_dictionaries_of_bounded_size_give_the_same_counts(spark, monkeypatch):
    import pyarrow as pa

    rows = audit_rows()
    batch = pa.RecordBatch.from_pylist([{"lang": a or "", "source": s or "", "text": t or ""} for a, s, t in rows])
    total = lambda: sum((Counter({(r["lang"], r["source"], r["term"]): r["n"]}) for b in divergence._counted(iter([batch])) for r in b.to_pylist()), Counter())
    want = total()
    monkeypatch.setattr(divergence, "_ENTRIES", 10)
    assert total() == want


# --- ball k-means -------------------------------------------------------------------------------------------------------


def plain_kmeans(vectors, k, rounds, seed=3, scale=1024):
    from fractions import Fraction

    x = [[int(Fraction(v) * scale // 1) for v in row] for _, row in vectors]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    start = sorted(range(len(x)), key=lambda i: (vectors[i][0] is None, digest(vectors[i][0]), vectors[i][1]))[:k]
    c = [x[i] for i in start]
    d = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    assign = lambda: [min(range(len(c)), key=lambda j: (d(row, c[j]), j)) for row in x]
    for _ in range(rounds):
        to = assign()
        for j in range(len(c)):
            if of := [row for row, t in zip(x, to, strict=True) if t == j]:
                c[j] = [sum(col) // len(of) for col in zip(*of, strict=True)]
    to = assign()
    dist = [d(row, c[t]) for row, t in zip(x, to, strict=True)]
    spread = [sum(e for e, t in zip(dist, to, strict=True) if t == j) for j in range(len(c))]
    return Counter((i, t, e, spread[t], sum(dist), hashlib.sha256(",".join(map(str, c[t])).encode()).hexdigest()) for (i, _), t, e in zip(vectors, to, dist, strict=True))


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int")
    return Counter(tuple(r) for r in ball_kmeans.cluster(df, **options).collect())


def vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    return [(i, [float(v) for v in centres[i % 5] + 0.3 * spread * rng.normal(size=width)]) for i in range(n)]


@pytest.mark.parametrize("reform", [0.0, 0.1, 1.0])
def test_clusters_equal_plain_kmeans(spark, reform):
    rows = vectors(120, 4, 1)
    assert clustered(spark, rows, k=6, rounds=5, width=4, reform=reform) == plain_kmeans(rows, 6, 5)


def test_ties_repeats_and_whole_numbers(spark):
    grid = [(i, [float(i % 5) / 1024, float(i // 5 % 5) / 1024]) for i in range(50)]  # many equal distances, every vector twice
    rows = [*grid, grid[0], (None, [0.0, 0.0]), (-7, [-0.0001, 3e-4])]
    assert clustered(spark, rows, k=8, rounds=4, width=2) == plain_kmeans(rows, 8, 4)


def test_large_components_stay_exact(spark):
    rows = [(i, [v * 3e5 for v in row]) for i, row in vectors(30, 3, 2)]
    assert clustered(spark, rows, k=3, rounds=3, width=3) == plain_kmeans(rows, 3, 3)


def test_unusable_vectors_go(spark):
    good = vectors(5, 3, 4)
    bad = [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [1.0, float("nan"), 0.0]), (95, [float("inf"), 0.0, 0.0]), (96, [1.0] * 4)]
    assert clustered(spark, good + bad, k=8, rounds=2, width=3) == plain_kmeans(good, 8, 2)
    assert not clustered(spark, bad, width=3) and not clustered(spark, [], width=3)


def test_balls_spare_comparisons_and_lose_no_neighbour():
    rng = np.random.default_rng(6)
    centroids = np.round(rng.normal(size=(12, 8)) * 500)
    to = rng.integers(0, 12, 3000)
    x = np.round(centroids[to] + rng.normal(size=(3000, 8)) * 20)
    found, distance, compared = ball_kmeans.nearest(x, centroids, to)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert compared < 0.3 * every.size
    for before in (np.zeros(3000, int), rng.integers(0, 12, 3000)):  # any assignment gives the same clusters
        assert (ball_kmeans.nearest(x, centroids, before)[0] == found).all()


# --- WARC ---------------------------------------------------------------------------------------------------------------

PAGES = [
    (5, "http://a.test/x y", "<html>" + "ä" * 80 + "</html>"), (3, "http://a.test/2", "<html>" + "ä" * 80 + "</html>"), (9, "http://b.test/\n", "<html>" + "ä" * 80 + "</html>"),
    (1, None, "short"), (2, "http://c.test", "short"), (4, "http://d.test", None), (6, "http://e.test", ""), (7, "http://f.test", "x" * 3_000_000),
    (8, "http://g.test", "\r\n\r\nWARC/1.1\r\n" * 20), (None, "http://h.test", "<html>" + "ä" * 80 + "</html>"), (10, "", "y" * 100), (11, "", "y" * 100), (12, "", "z" * 99), (13, "", "z" * 99), (14, "http://i.test", "q" * 300),
    (14, "http://i.test", "q" * 300),
]


def page_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload string, salt int")


def plain_pages(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same, default=None)
        again = len(body) >= 100 and first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


def test_archives_round_trip(spark, tmp_path):
    folder = f"{tmp_path}/warc"
    warc.write(page_frame(spark, PAGES), folder)
    rows = warc.checked(warc.load(spark, folder, payload=False))
    assert Counter(map(tuple, rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())) == plain_pages(PAGES)
    back = Counter((r.page_id, r.html) for r in warc.restored(warc.load(spark, folder)).collect())
    assert back == Counter((i, h or "") for i, _, h in PAGES)
    urls = {r.page_id: r.url for r in warc.load(spark, folder, payload=False).collect()}
    assert urls[5] == "http://a.test/x%20y" and urls[9] == "http://b.test/%0A" and urls[1] is None and urls[10] == ""
    assert not [p for p in (tmp_path / "warc").iterdir() if p.name.startswith("_")]


def test_every_member_holds_one_record(spark, tmp_path):
    warc.write(page_frame(spark, PAGES).coalesce(1), f"{tmp_path}/w")
    members = 0
    for path in (tmp_path / "w").iterdir():
        data = path.read_bytes()
        assert gzip.decompress(data).count(b"WARC-Type: ") == data.count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00")
        members += data.count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00")
    assert members == len(PAGES)


def test_no_pages(spark, tmp_path):
    warc.write(page_frame(spark, PAGES[:1]).limit(0), f"{tmp_path}/none")
    assert warc.checked(warc.load(spark, f"{tmp_path}/none")).collect() == []


def archive(*texts):
    parts = []
    for i, t in enumerate(texts):
        body = t.encode()
        parts.append(warc.member(*warc.record(i, "http://x.test", "response", None, len(body), hashlib.sha256(body).hexdigest(), body, "2020-01-01T00:00:00Z"), b"\r\n\r\n"))
    return parts


def test_reader_in_small_pieces(monkeypatch):
    texts = ["one", "", "two " * 999, "é" * 70]
    for piece in (1, 2, 7, 100, 1 << 18):
        monkeypatch.setattr(warc, "PIECE", piece)
        got = [r[-1].decode() for r in warc.records(io.BytesIO(b"".join(archive(*texts))), "a")]
        assert got == texts


def test_other_records_are_passed_over_and_other_digests_are_known():
    import base64

    info = warc.member(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n")
    body = b"hello"
    http = b"HTTP/1.1 200 OK\r\ncontent-length: 5\r\nX-Long: a\r\n b\r\n\r\n" + body
    sha1 = base64.b32encode(hashlib.sha1(body).digest())
    old = warc.member(b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:page:4>\r\nWARC-Payload-Digest: sha1:" + sha1 + b"\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n")
    assert list(warc.records(io.BytesIO(info + old + info), "a")) == [(4, None, "response", None, 5, hashlib.sha1(body).hexdigest(), body)]


@pytest.mark.parametrize(("harm", "says"), [
    (lambda h, b: (h, b.replace(b"text", b"test"), b"\r\n\r\n"), "digest"), (lambda h, b: (h, b + b"!", b"\r\n\r\n"), "longer"), (lambda h, b: (h, b[:-9]), "shorter"),
    (lambda h, b: (b"X" + h, b, b"\r\n\r\n"), "starts"), (lambda h, b: (h.replace(b"Content-Length", b"Content-Size"), b, b"\r\n\r\n"), "content-length"),
])
def test_wrong_records_are_named(harm, says):
    body = b"some text of a page"
    head, block = warc.record(1, None, "response", None, len(body), hashlib.sha256(body).hexdigest(), body, "2020-01-01T00:00:00Z")
    with pytest.raises(warc.ArchiveError, match=f"record 2.*{says}"):
        list(warc.records(io.BytesIO(archive("fine")[0] + warc.member(*harm(head, block))), "a"))


def test_cut_archives_stop_the_read(spark, tmp_path):
    data = b"".join(archive("one", "two" * 100))
    with pytest.raises(warc.ArchiveError, match="cut"):
        list(warc.records(io.BytesIO(data[:-5]), "a"))
    (tmp_path / "cut.warc.gz").write_bytes(data[:-5])
    with pytest.raises(PySparkException, match="cut inside a record"):
        warc.load(spark, str(tmp_path)).collect()


def test_revisits_need_their_response(spark, tmp_path):
    warc.write(page_frame(spark, PAGES), f"{tmp_path}/w")
    with pytest.raises(PySparkException, match="a revisit without its response"):
        warc.checked(warc.load(spark, f"{tmp_path}/w").filter("not (page_id <=> 3)")).collect()
    assert warc.load(spark, f"{tmp_path}/w").filter(F.col("record_type") == "revisit").count() == 4
