"""Quality rules, quality classifier, mixing and licence scans."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from panelyx.llm import license_scan, mixing, quality_classifier, quality_rules
from panelyx.llm.license_texts import ISC, MIT

from .helpers import CLASHES, awkward_rows, empty, frame, labels, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    twice = {g for g, n in Counter(zip(w, w[1:], w[2:], strict=False)).items() if n > 1}
    covered = {k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if g in twice for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", "".join(w))), len(lines) - len(set(lines)), len(covered)


def labelled(n=240):
    """Good prose, symbol junk and repetition; every fourth text is bad, every ninth good one rude."""
    rows, marks = [], []
    for i in range(n):
        w = words(80 + i % 50, i)
        bad = i % 4 == 0
        if bad:
            w = [x + "###" for x in w] if i % 8 else [w[0]] * 80
        rude = not bad and i % 9 == 1
        if rude:
            w[5] = w[30] = "rudeword"
        rows.append((i, " ".join(w)))
        marks.append((i, int(not bad), int(rude)))
    return rows, marks


def test_counts_equal_brute_force(spark):
    rows = [*awkward_rows(), (30, "a b c a b c a b"), (31, "x y z\nx y z\n x y z\n\n"), (32, "# a|b <é> 100% $5")]
    out = quality_rules.statistics(frame(spark, rows, CLASHES)).collect()
    want = Counter((i, *brute_counts(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want


def test_rules_are_learned_and_base_rule_holds(spark):
    rows, marks = labelled()
    docs = frame(spark, rows + awkward_rows()[3:8], CLASHES)
    rules = quality_rules.fit(docs, labels(spark, marks))
    assert rules.rules
    out = {r.doc_id: r for r in quality_rules.judged(docs, rules).collect()}
    right = [out[i].kept == bool(q) for i, q, _ in marks]
    assert np.mean(right) > 0.97
    assert not out[6].kept and out[6].base_failed
    assert not any(r.kept and r.base_failed for r in out.values())
    assert "CASE WHEN" in str(rules.column())


def test_rules_without_labels(spark):
    rows, marks = labelled(8)
    rules = quality_rules.fit(frame(spark, rows), labels(spark, marks).filter("false"))
    assert rules.rules == []
    assert quality_rules.judged(empty(spark), rules).count() == 0


def test_classifier_held_out_accuracy(spark):
    rows, marks = labelled(400)
    docs = frame(spark, rows, CLASHES)
    out = {r.doc_id: r for r in quality_classifier.classified(docs, labels(spark, marks)).collect()}
    held = [i for i, *_ in marks if out[i].held_out]
    assert 0.1 < len(held) / len(marks) < 0.3
    assert np.mean([out[i].predicted == marks[i][1] for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in out.values())


def test_classifier_never_learns_held_out_rows_and_takes_awkward_ones(spark):
    rows, marks = labelled(120)
    docs = frame(spark, rows, CLASHES)
    a = quality_classifier.fit(docs, labels(spark, marks))
    from zlib import crc32

    flipped = [(i, 1 - q if crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in marks]
    b = quality_classifier.fit(docs, labels(spark, flipped))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
    out = quality_classifier.score(frame(spark, awkward_rows(), CLASHES), a).collect()
    assert len(out) == len(awkward_rows()) and len({r.score for r in out if r.doc_id in (6, 7, 8)}) == 1
    assert quality_classifier.score(empty(spark), a).count() == 0
    none = quality_classifier.fit(docs, labels(spark, marks).filter("false"))
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}


def test_keep_good_returns_documents(spark):
    rows, marks = labelled(300)
    docs = frame(spark, rows, CLASHES)
    out = quality_classifier.keep_good(docs, labels(spark, marks))
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert np.mean([i in kept for i, q, _ in marks if q]) > 0.97 and np.mean([i in kept for i, q, _ in marks if not q]) < 0.2


def test_mixing_meets_targets(spark):
    rows, marks = labelled(400)
    docs = frame(spark, rows + awkward_rows(), CLASHES)
    weights = {"clean": 0.9, "low": 0.06, "toxic": 0.04}
    out = mixing.rates(docs, labels(spark, marks), weights=weights).toPandas()
    assert len(out) == len(rows) + len(awkward_rows()) and (out.rate >= 0).all() and (out.copies >= 0).all()
    sums = {d: float((out.rate * out.tokens * out[f"p_{d}"]).sum()) for d in weights}
    total = sum(sums.values())
    assert all(abs(sums[d] / total - w) < 0.02 for d, w in weights.items())
    p = out[out.doc_id < 400].drop_duplicates("doc_id").set_index("doc_id")
    right = [p.loc[i, ["p_clean", "p_low", "p_toxic"]].to_numpy(float).argmax() == (2 if t else 0 if q else 1) for i, q, t in marks if i > 20]
    assert np.mean(right) > 0.9


def test_mixing_steps_equal_numpy(spark):
    rng = np.random.default_rng(0)
    t, p = rng.integers(1, 100, 200), rng.dirichlet([1, 1, 1], 200)
    rows = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(t, p, strict=True)], "__tokens long, __p0 double, __p1 double, __p2 double")
    steps = mixing.solve(rows, {"clean": 0.6, "low": 0.3, "toxic": 0.1}, max_steps=5, tolerance=0.0)
    r, mass = np.ones(200), p.T @ t
    target = np.array([0.6, 0.3, 0.1]) * mass[0] / 0.6
    for _ in range(len(steps.gradients)):
        r = np.maximum(0, r - p @ ((p.T @ (r * t) - target) / mass))
    got = np.sort([x.r for x in rows.select(steps.rate().alias("r")).collect()])
    assert np.allclose(got, np.sort(r))


def test_mix_repeats_rows_and_keeps_columns(spark):
    rows, marks = labelled(200)
    docs = frame(spark, rows, CLASHES)
    rated = {r.doc_id: r.copies for r in mixing.rates(docs, labels(spark, marks)).collect()}
    out = mixing.mix(docs, labels(spark, marks))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter({i: n for i, n in rated.items() if n})
    assert mixing.rates(empty(spark), labels(spark, marks)).count() == 0


def test_licences(spark):
    rows = [
        (1, MIT.upper()), (2, "Copyright (c) 2020 Someone\n\n" + MIT.replace('"', "'").replace(",", " ,")), (3, "some text\nReleased under the MIT Licence\nmore"), (4, ISC + "\nand more words"),
        (5, "Licensed under CC BY-NC 4.0.\nlicensed under cc by nc 4.0"), *awkward_rows()[5:9],
    ]
    out = {r.doc_id: r for r in license_scan.scan(frame(spark, rows, CLASHES)).collect()}
    assert out[1].text_license == out[2].text_license == "MIT"
    assert out[3].text_license is None and (out[3].n_license_lines, out[3].licenses) == (1, "MIT")
    assert out[4].text_license is None and out[5].n_license_lines == 2
    assert all(out[i].licenses == "" for i in (6, 7, 8, 9))
    again = license_scan.scan(frame(spark, [rows[2], rows[2]])).collect()
    assert [r.n_license_lines for r in again] == [1, 1]
    assert license_scan.scan(empty(spark)).count() == 0


def test_template_copyright_lines_go(spark):
    title, body = MIT.split("\n", 1)
    heads = ["Copyright (c) <year> <copyright holders>", "Copyright (C) The Authors of This Rather Long Project", "Copyright [yyyy] [name of copyright owner]", "© {year} {name of the copyright holders}"]
    rows = [(k, f"{title}\n\n{head}\n\n{body}") for k, head in enumerate(heads)] + [(9, f"{title}\nCopyright law protects this text and its readers\n{body}")]
    out = {r.doc_id: r.text_license for r in license_scan.scan(frame(spark, rows)).collect()}
    assert all(out[k] == "MIT" for k in range(4)) and out[9] is None


def test_whole_licences_are_known_however_they_are_set():
    from panelyx.llm.license_texts import DIGESTS

    assert len(set(DIGESTS)) == len(DIGESTS) == len({d for _, d in DIGESTS}) and all(len(d) == 64 for _, d in DIGESTS)


@pytest.mark.parametrize("name, license", [("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0-only"), ("MPL-2.0", "MPL-2.0"), ("LGPL-2.1", "LGPL-2.1-only"), ("CC0-1.0", "CC0-1.0")])
def test_full_licence_texts(spark, name, license):
    path = Path("/usr/share/common-licenses") / name
    if not path.exists():
        pytest.skip("this system ships no licence texts")
    text = path.read_text(encoding="utf-8")
    rows = [
        (1, text), (2, "Copyright (c) 2031 Some One\n\n" + text.upper().replace(", ", " , ")), (3, text.replace("license", "licence").replace(" ", "  \t")),
        (4, text.replace("the", "thy", 1)), (5, text + "\nAnd more."),
    ]
    out = {r.doc_id: r.text_license for r in license_scan.scan(frame(spark, rows)).collect()}
    assert out == {1: license, 2: license, 3: license, 4: None, 5: None}


def test_spellings_begin_at_words(spark):
    rows = [(1, "super cent"), (2, "supercent"), (3, "ten per cent"), (4, "ten percent"), (5, "Licences"), (6, "licenses"), (7, "to fulfil\nit"), (8, "to fulfill it")]
    d = {r.doc_id: r.text_digest for r in license_scan.scan(frame(spark, rows)).collect()}
    assert d[1] != d[2] and d[3] == d[4] and d[5] == d[6] and d[7] == d[8]


def test_label_rows_without_a_mark_are_no_labels(spark):
    rows = spark.createDataFrame([(1, None, None), (2, 0, None), (3, None, 1), (4, 1, None), (5, None, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    assert [r.d for r in rows.orderBy("doc_id").select(mixing.domain(rows).alias("d")).collect()] == [None, 1, 2, 0, 0, 2]
