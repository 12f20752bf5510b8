"""Quality rules (operator 1): a decision list learned by sequential covering.

Statistics of whole texts are counted in one pass. From a bounded sample of labelled rows (at most ``sample_rows``,
those with the smallest hash of their id; the bound is a documented parameter) sequential covering learns an ordered
list: each rule is a conjunction of thresholds on statistics that is grown on two thirds of the rows left by FOIL
gain, pruned on the last third by (p - n) / (p + n), and accepted while its precision there is high enough; rows that
it covers are then set aside. The list is emitted as one ordered Spark conditional expression, so the verdict runs
inside the plan.

Defined results: null and empty texts have zero in every statistic and fail the base rule; without labelled rows, or
without rows of both labels, the list is empty and the base rule decides; repeated rows are judged alike; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, WHITE, small_batches

SAMPLE_ROWS = 6_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_alone")
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
_WHITE = WHITE.encode()
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?.,;:\"'()[]{}/\\-_=+~^@`"
_CONTINUED = bytes(range(0x80, 0xC0))


def repeat_words(codes: np.ndarray, kinds: int) -> int:
    """Words covered by a window of three words that the text holds twice or more, its first copy included."""
    if len(codes) < 4:
        return 0
    if kinds < 2_000_000:  # three codes fit into 63 bits
        keys = (codes[:-2] * kinds + codes[1:-1]) * kinds + codes[2:]
    else:
        pairs = np.unique(codes[:-1] * kinds + codes[1:], return_inverse=True)[1].astype(np.int64)
        keys = pairs[:-1] * (len(codes) + 1) + pairs[1:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[:-1][same]] = True
    twice[order[1:][same]] = True
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[k : k + len(keys)] |= twice
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    codes: dict[bytes, int] = {}
    number = np.fromiter([codes.setdefault(w, len(codes)) for w in words], np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    points = len(data) - len(data.translate(None, bytes(set(range(256)) - set(_CONTINUED))))
    white = len(data) - len(data.translate(None, _WHITE))
    gone = lambda chars: len(data) - len(data.translate(None, chars))
    return (
        len(words), points - white, gone(_SYMBOLS), len(lines) - len(set(lines)), repeat_words(number, len(codes)), len(lines),
        len(codes), gone(UPPER), gone(b"0123456789"), gone(_MARKS), int((np.diff(number) == 0).sum()) + words.count(b"|"),
    )


def statistics(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and COUNTS of every row; extra: further long columns of docs to keep."""
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray([counts_of(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(len(COUNTS))), *batch.columns[2:]], names=["doc_id", *COUNTS, *extra])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(c).cast("long").alias(c) for c in extra))
    return chosen.mapInArrow(counted, _SCHEMA + "".join(f", {c} long" for c in extra))


#: What rules may test: name, numerator, denominator (counts), both as Spark columns and as arrays.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "doubled_word_share": ("n_alone", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Test:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        top, bottom = RATIOS[self.name]
        ratio = F.col(top) / F.greatest(F.col(bottom), F.lit(1))
        return ratio > F.lit(self.threshold) if self.above else ratio <= F.lit(self.threshold)

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.threshold if self.above else x[self.name] <= self.threshold


@dataclass
class DecisionList:
    """Rules in order; a row that a rule covers is rejected, a row that none covers is kept."""

    rules: list[tuple[Test, ...]] = field(default_factory=list)

    def column(self) -> Column:
        out = F.lit(True)
        for rule in reversed(self.rules):
            held = F.lit(True)
            for test in rule:
                held = held & test.column()
            out = F.when(held, F.lit(False)).otherwise(out)
        return out

    def kept(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out &= ~np.logical_and.reduce([t.mask(x) for t in rule])
        return out


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray, steps: int) -> tuple[float, Test | None]:
    """The threshold with the largest FOIL gain among the covered rows."""
    p0, n0 = (bad & covered).sum(), (~bad & covered).sum()
    best: tuple[float, Test | None] = (1e-9, None)
    start = np.log2(p0 / (p0 + n0))
    for name, values in x.items():
        own = values[covered]
        cuts = np.unique(np.quantile(own, np.linspace(0, 1, steps)))
        cuts = np.unique(np.concatenate([cuts, (cuts[1:] + cuts[:-1]) / 2]))
        order = np.argsort(own, kind="stable")
        hits = np.concatenate([[0], np.cumsum(bad[covered][order])])
        at = np.searchsorted(own[order], cuts, "right")
        for above in (False, True):
            p = p0 - hits[at] if above else hits[at]
            n = (len(own) - at if above else at) - p
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - start), 0.0)
            if gain.max() > best[0]:
                cut = float(cuts[np.argmax(gain)])
                below, over = own[own <= cut], own[own > cut]  # halfway between the values on either side
                best = (float(gain.max()), Test(name, above, float(below.max() + over.min()) / 2 if len(below) and len(over) else cut))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, *, max_rules: int = 12, max_tests: int = 4, precision: float = 0.97, steps: int = 64) -> DecisionList:
    """Sequential covering of the rows marked bad."""
    found = DecisionList()
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(found.rules) < max_rules and (bad & left & ~third).sum() >= 3:
        rule: list[Test] = []
        covered = left & ~third
        while len(rule) < max_tests and (~bad & covered).any():
            test = _best_test(x, bad, covered, steps)[1]
            if test is None:
                break
            rule.append(test)
            covered = covered & test.mask(x)
        if not rule:
            break

        def worth(tests: list[Test], rows: np.ndarray) -> tuple[float, int, int]:
            held = rows & np.logical_and.reduce([t.mask(x) for t in tests])
            p, n = int((bad & held).sum()), int((~bad & held).sum())
            return (p - n) / (p + n) if p + n else -1.0, p, n

        rows = left & third
        while len(rule) > 1 and worth(rule[:-1], rows)[0] >= worth(rule, rows)[0]:
            rule.pop()
        _, p, n = worth(rule, left)
        if p < 3 or p < precision * (p + n):
            break
        found.rules.append(tuple(rule))
        left &= ~np.logical_and.reduce([t.mask(x) for t in rule])
    return found


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DecisionList:
    """Learn from at most sample_rows labelled rows; their counts reach the driver."""
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("label"))
        .dropna().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    pdf = statistics(rows, "label").toPandas().sort_values(["doc_id", *COUNTS], kind="stable")
    bad = pdf["label"].to_numpy() == 0
    if bad.all() or not bad.any():
        return DecisionList()
    shuffled = np.random.default_rng(0).permutation(len(bad))
    x = {name: (pdf[top] / pdf[bottom].clip(lower=1)).to_numpy()[shuffled] for name, (top, bottom) in RATIOS.items()}
    return learn(x, bad[shuffled])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, counts, base_failed and kept of every row of docs."""
    return statistics(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.column())


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
