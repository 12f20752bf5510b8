"""Quality classifier (operator 2): hashed word n-gram logistic regression.

Features are word unigrams and bigrams (equal pairs also as such) hashed into ``2**bits`` slots, and hashed shapes of words (letters, digits and
marks reduced to classes), which carry over to words never seen; each text's feature values are damped counts with
unit length. Training is follow-the-regularised-leader (per-coordinate rates, L1 and L2), over a bounded sample of
labelled rows: at most ``sample_rows`` (a documented bound), those with the smallest hash of their id. A text's score
is the logistic function of the sparse dot product of its features and the weights.

Defined results: null and empty texts have no feature and get the bias' score; without labelled rows the score is
0.5; rows that repeat are scored alike; other columns of the documents are ignored; the id is never an input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, small_batches, word_codes32

BITS = 18
SAMPLE_ROWS = 6_000
#: Shapes: lower case a, upper case A, digit 0, other bytes of multi-byte characters a, marks as they are; runs are cut to one.
_SHAPE = bytes(0x61 if 97 <= b <= 122 or b >= 128 else 0x41 if 65 <= b <= 90 else 0x30 if 48 <= b <= 57 else b for b in range(256))


def _squeezed(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Code of each word's shape with runs cut to one."""
    import re
    import zlib

    out = np.empty(len(words), np.uint32)
    for i, w in enumerate(words):
        code = known.get(w)
        if code is None:
            if len(known) > 50_000:
                known.clear()
            code = known[w] = zlib.crc32(re.sub(rb"(.)\1+", rb"\1", w, flags=re.DOTALL))
        out[i] = code
    return out


def features(text: str | None, bits: int, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a whole text; values have unit length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    one = word_codes32(words)
    shape = _squeezed(data.translate(_SHAPE).split(), known)
    codes = [one * np.uint32(0x9E3779B1), shape * np.uint32(0x85EBCA6B) + np.uint32(77)]
    for x, salt in ((one, 0x27D4EB2F), (shape, 0x165667B1)):
        codes.append((x[:-1] * np.uint32(0xC2B2AE35) ^ (x[1:] * np.uint32(salt) + np.uint32(salt))) * np.uint32(0x9E3779B1))
    # bigrams and skip bigrams of equal words share one slot each: repetition shows whatever the word is
    codes += [np.full(int((one[k:] == one[:-k]).sum()), 0xA5A5A5A5 + (k << 24 & 0xFFFFFFFF) & 0xFFFFFFFF, np.uint32) for k in (1, 2)]
    slots, counts = np.unique(np.concatenate(codes) >> np.uint32(32 - bits), return_counts=True)
    values = np.log1p(counts).astype(np.float32)
    return slots.astype(np.int32), values / np.float32(np.sqrt((values * values).sum()))


@dataclass
class Model:
    bits: int
    weights: np.ndarray  # float32, 2**bits
    bias: float


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, passes: int = 3) -> Model:
    """rows: label, slots, values. One follow-the-regularised-leader update for each row and pass, in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(passes):
        for label, slots, values in rows:
            zi, ni = z[slots], n[slots]
            w = weight(zi, ni)
            bias = -zb / ((beta + nb**0.5) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(float(w @ values) + bias, -30, 30)))
            g = (p - label) * values
            z[slots] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[slots] = ni + g * g
            gb = p - label
            zb += gb - ((nb + gb * gb) ** 0.5 - nb**0.5) / alpha * bias
            nb += gb * gb
    return Model(bits, weight(z, n).astype(np.float32), -zb / ((beta + nb**0.5) / alpha))


def sample_of_labels(labels: DataFrame, label_col: str, modulus: int | None, rows: int) -> DataFrame:
    """doc_id and label of at most rows labelled documents; ids with remainder 0 by modulus are never among them."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    if modulus:
        ids = ids.filter(id_remainder(F.col("doc_id"), modulus) != 0)
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", bits: int = BITS, held_out_modulus: int | None = 5, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most sample_rows labelled rows; their hashed features, not their texts, reach the driver."""
    small_batches(docs.sparkSession)
    sample = sample_of_labels(labels, label_col, held_out_modulus, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = [features(t, bits, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([s for s, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=["doc_id", "label", "slots", "values"],
            )

    table = rows.mapInArrow(hashed, "doc_id long, label int, slots array<int>, values array<float>").toArrow()
    ids = table["doc_id"].to_numpy()
    found = [(int(y), np.asarray(s.values, np.int32), np.asarray(v.values, np.float32)) for y, s, v in zip(table["label"].to_pylist(), table["slots"], table["values"], strict=True)]
    order = np.argsort(np.asarray([hash((int(i) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) for i in ids], np.int64), kind="stable") if len(ids) else []
    return fit_ftrl([found[i] for i in order], bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        known: dict[bytes, int] = {}
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1).to_pylist()):
                slots, values = features(text, m.bits, known)
                out[i] = float(m.weights[slots] @ values) + m.bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(out, -30, 30))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scored, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, held_out_modulus: int = 5, **options) -> DataFrame:
    model = fit(docs, labels, held_out_modulus=held_out_modulus, **options)
    return score(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), held_out_modulus) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **options) -> DataFrame:
    """docs without the rows scored under threshold; all columns of docs and no others."""
    model = fit(docs, labels, **options)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        known: dict[bytes, int] = {}
        for batch in batches:
            scores = [float(m.weights[s] @ v) + m.bias for s, v in (features(t, m.bits, known) for t in batch.column(at).to_pylist())]
            yield batch.filter(pa.array(1.0 / (1.0 + np.exp(-np.clip(np.asarray(scores, float), -30, 30))) >= threshold))

    return docs.mapInArrow(kept, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return classified(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
