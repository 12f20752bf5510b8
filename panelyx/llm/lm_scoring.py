"""Language-model scores of whole documents (operator 7): a gated recurrent network trained here.

Counts. Every token of every training document is counted (hash of the word, combined before the shuffle); N tokens,
V distinct ones. The most frequent ``head`` words, a bounded table, are sent to all tasks; what is left of a document
is joined with the counts, so that no vocabulary is broadcast whole and no frequent word heats a join key.

Network. Its vocabulary is the ``vocabulary`` most frequent words, the end token and one class for all other words,
whose probability is split among them in proportion to count + 1 (with one share for unseen words). The training
documents are dealt over the rounds by a hash of row id and text, so that each of them is trained on once, at every
size of the input. In a round each partition runs truncated backpropagation from the same weights over its whole texts
(those over 1,024 tokens in several stretches), and the weights are averaged by tokens, in two steps. The model thus
depends on how the documents lie in partitions, a little; the base score does not. What is gathered grows with the
input. Scoring carries the state through every whole document, whatever its length.

A 64-bit hash stands for a word; END is hash 0. Defined results: null and empty texts are the end token alone; without
training documents N and V are 0 and every token is unseen; repeated rows are scored alike; a null id is a training
document (it has no remainder); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import cut, id_remainder, lower_words_of, small_batches

HEAD = 200_000
VOCABULARY = 1_022
END = 0
#: Tokens of a task's texts that run in lockstep.
CHUNK = 3_000_000
SLOTS = 16


def token_codes(text: str | None) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = lower_words_of(text)
    out = np.zeros(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    return out.view(np.int64)


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _training(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return _base(docs).filter(F.coalesce(id_remainder(F.col("doc_id"), modulus) != remainder, F.lit(True)))


def token_counts(training: DataFrame) -> DataFrame:
    """h and c of every distinct token."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["h", "c"])
            counts.clear()
            return out

        for batch in batches:
            codes = np.concatenate([token_codes(t) for t in batch.column(1).to_pylist()] or [np.empty(0, np.int64)])
            distinct, n = np.unique(codes, return_counts=True)
            for h, c in zip(distinct.tolist(), n.tolist(), strict=True):
                counts[h] += c
            if len(counts) > 400_000:
                yield batch_of()
        yield batch_of()

    return training.mapInArrow(counted, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Head:
    """The most frequent words, the network's ids among them, and the weights of its open class."""

    def __init__(self, h: np.ndarray, c: np.ndarray, tokens: int, kinds: int, end: int, vocabulary: int):
        """h, c: most frequent first, END left out."""
        self.tokens, self.kinds, self.end = tokens, kinds, end
        inside = h[:vocabulary]
        other = tokens - int(c[:vocabulary].sum()) - end
        # counts by id: sorted, with the end token and the open class among the words
        names = np.concatenate([inside, [END, END]])
        what = np.concatenate([np.zeros(len(inside), int), [1, 2]])
        counts = np.concatenate([c[:vocabulary], [end, other]]).astype(float)
        order = np.argsort(-counts, kind="stable")
        self.counts = np.maximum(counts[order], 1.0)
        self.end_id, self.other_id = int(np.flatnonzero(what[order] == 1)[0]), int(np.flatnonzero(what[order] == 2)[0])
        ids = {int(names[k]): i for i, k in enumerate(order) if what[k] == 0}
        by_hash = np.argsort(h, kind="stable")
        self.h, self.c = h[by_hash], c[by_hash]
        self.id = np.asarray([ids.get(int(x), self.other_id) for x in self.h], np.int32)
        self.inner = np.sort(inside)
        self.inner_id = np.asarray([ids[int(x)] for x in self.inner], np.int32)
        # shares of the open class: count + 1 of each trained word, and one for any unseen word
        self.other_mass = other + (kinds - len(inside) - (1 if end else 0)) + 1

    def network_ids(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.inner):
            ids = np.full(len(codes), self.other_id, np.int32)
        else:
            at = np.minimum(np.searchsorted(self.inner, codes), len(self.inner) - 1)
            ids = np.where(self.inner[at] == codes, self.inner_id[at], self.other_id).astype(np.int32)
        ids[-1] = self.end_id
        return ids

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Network ids, counts (0 if not in this table), whether in this table (the end token is)."""
        at = np.minimum(np.searchsorted(self.h, codes), max(len(self.h) - 1, 0))
        held = self.h[at] == codes if len(self.h) else np.zeros(len(codes), bool)
        ids = np.where(held, self.id[at] if len(self.h) else 0, self.other_id).astype(np.int32)
        counts = np.where(held, self.c[at] if len(self.h) else 0, 0)
        ids[-1], counts[-1], held[-1] = self.end_id, self.end, True
        return ids, counts, held


def head_of(counts: DataFrame, head: int, vocabulary: int) -> Head:
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.max(F.when(F.col("h") == END, F.col("c"))), F.lit(0)).alias("e")).first()
    # a threshold on counts, read off a histogram of at most a few thousand rows, bounds what reaches the driver
    words = counts.filter(F.col("h") != END).withColumn("bin", F.floor(F.log("c") * 64))
    bins = sorted(((r["bin"], r["count"]) for r in words.groupBy("bin").count().collect()), reverse=True)
    least, held = (bins[0][0] + 1 if bins else 0), 0
    for at, n in bins:
        if held + n > head:
            break
        least, held = at, held + n
    top = words.filter(F.col("bin") >= F.lit(least)).select("h", "c").toPandas().sort_values(["c", "h"], ascending=[False, True])
    return Head(top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), facts["n"], facts["v"], facts["e"], vocabulary)


def trained(training: DataFrame, head: Head, *, rounds: int = 2, hidden: int = 16) -> gru.Model:
    """Rounds of local training on every partition's whole texts, averaged by tokens; every document is in one round."""
    context = training.sparkSession.sparkContext
    model = gru.Model(head.counts, hidden)
    sent_head = context.broadcast(head)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**20))
    for at in range(rounds):
        chosen = training.filter(F.floor(place * rounds / 2**20) == at)
        sent = context.broadcast(model)

        def learned(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = gru.Model(sent_head.value.counts, hidden).load(sent.value.vector())
            seen, waiting, size = 0, [], 0
            for batch in batches:
                for text in batch.column(1).to_pylist():
                    waiting.append(sent_head.value.network_ids(token_codes(text)))
                    size += len(waiting[-1])
                if size > CHUNK:
                    seen, waiting, size = seen + gru.train(own, waiting), [], 0
            if waiting:
                seen += gru.train(own, waiting)
            if seen:
                blocks = np.array_split(own.vector().astype(np.float64) * seen, SLOTS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLOTS), pa.int32()), pa.array([int(own.vector()[:64].view(np.uint32).sum()) % 32] * SLOTS, pa.int32()), pa.array([seen] * SLOTS, pa.int64()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                    names=["slot", "branch", "seen", "block"],
                )

        def summed(pdf: pd.DataFrame) -> pd.DataFrame:
            block = sum(np.frombuffer(b, np.float64) for b in pdf["block"])
            return pd.DataFrame({"slot": pdf["slot"].iloc[:1], "seen": [pdf["seen"].sum()], "block": [block.tobytes()]})

        shape = "slot int, seen long, block binary"
        sums = chosen.mapInArrow(learned, "slot int, branch int, seen long, block binary").groupBy("slot", "branch").applyInPandas(summed, shape)
        found = sums.groupBy("slot").applyInPandas(summed, shape).toPandas().sort_values("slot")
        if len(found):
            model = gru.Model(head.counts, hidden).load(np.concatenate([np.frombuffer(b, np.float64) / n for b, n in zip(found["block"], found["seen"], strict=True)]))
    return model


_LN10 = float(np.log(10.0))


def scored(docs: DataFrame, *, modulus: int = 7, remainder: int = 2, head: int = HEAD, vocabulary: int = VOCABULARY, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs (log10)."""
    spark = docs.sparkSession
    small_batches(spark)
    training = _training(docs, modulus, remainder)
    counts = cut(token_counts(training))
    table = head_of(counts, head, vocabulary)
    model = trained(training, table, **options)
    sent = spark.sparkContext.broadcast((table, model))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, m = sent.value
        base_mass, other_mass = np.log10(t.tokens + t.kinds + 1), np.log10(max(t.other_mass, 1))
        rows: list[tuple] = []
        texts: list[np.ndarray] = []
        tails: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            network = gru.score(m, texts) / _LN10
            doc_id, n, known, base, other = zip(*rows, strict=True)
            ends = np.concatenate([[0], np.cumsum([len(x) for x, _ in tails])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate([x[k] for x in tails])) for k in (0, 1)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.asarray(other) + network), *lists],
                names=["doc_id", "n_tokens", "known", "base", "net", "tail", "tail_n"],
            )
            for held in (rows, texts, tails):
                held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = token_codes(text)
                ids, c, held = t.ids(codes)
                logs = np.log10(c + 1.0)  # 0 outside the table: the join adds those
                other = ids == t.other_id
                rows.append((doc_id, len(ids), int((c > 0).sum()), float(logs.sum() - len(ids) * base_mass), float(logs[other].sum() - other.sum() * other_mass)))
                texts.append(ids)
                tails.append(np.unique(codes[~held], return_counts=True))
                size += len(ids)
            if size > CHUNK:
                yield batch_of()
                size = 0
        if rows:
            yield batch_of()

    # written once: the words outside the table go their own way to the counts, and back to their row by its place
    rows = cut(_base(docs).mapInArrow(judged, "doc_id long, n_tokens long, known long, base double, net double, tail array<long>, tail_n array<long>"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rest = (
        rows.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select("row", F.col("x.tail").alias("h"), F.col("x.tail_n").alias("n")).join(counts, "h")
        .groupBy("row").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("tail_log"))
    )
    tail = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.drop("tail", "tail_n").join(rest, "row", "left").select(
        "doc_id",
        F.coalesce(id_remainder(F.col("doc_id"), modulus) == remainder, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("known") + tail("tail_known")).cast("long").alias("n_known"),
        F.lit(int(table.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + tail("tail_log")).alias("base_score"),
        (F.col("net") + tail("tail_log")).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
