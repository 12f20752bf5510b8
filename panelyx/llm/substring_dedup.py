"""Substring deduplication with a compressed FM-index per shard (operator 10).

A window is 13 consecutive words. A word goes when a window that covers it also starts in a document with a smaller
id. Shards are cut by content, not by document: every window belongs to its smallest 5-word hash (its minimiser), so
equal windows always meet in one shard and no document has to be held against the whole corpus.

1. Minimisers that two different texts hold are found by a combining aggregation; windows of all others are unique.
   Tasks read them as a Bloom filter of bounded size from the shared folder, where tasks wrote it (the driver never
   holds it): what it holds too much only costs a few segments that repeat nothing.
2. Documents give their runs of windows with one such minimiser as segments. (Windows of a minimiser with very many
   holders are dealt one by one, by their own hash, so that no shard runs hot.) Equal segments combine before and in
   the shuffle, and keep the smallest id that holds them.
3. Each shard builds an FM-index of its distinct segments: suffix order to a depth of 16, Burrows-Wheeler transform,
   wavelet matrix over packed bits. Backward search of all windows gives their intervals and so the smallest id in
   each: a window's matching statistic reaches the threshold just where its interval holds an earlier document.
4. Every holder of a segment compares those ids with its own; what it loses comes back as ranges of windows.
5. A document whose whole word sequence a smaller id has loses every word.
6. A table of bits of fixed size, broadcast in pages, marks the documents that lose words. All others are answered
   where they are read; only marked ones are shuffled to their ranges. (A document marked in vain costs its shuffle and
   nothing else.)

Defined results: null and empty texts have no words; texts under 13 words keep all; rows that
share an id are one document and never remove each other's words; rows with a null id
come after all others and are judged against them; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, opened, shared_checkpoints, small_batches, words_of

WINDOW, GRAM = 13, 5
#: Minimisers with more holders than this are dealt window by window.
HOT = 500
#: Documents for each shard, on average.
SHARD = 256
#: Bits of the filter: 64 for each document (a dozen for each minimiser that repeats), between these powers of two (the larger is 32 MB).
FILTER_BITS = (16, 28)
#: Bits of the table that marks documents which lose words (8 MB), at every size of the input, and words of 64 bits in a page of it.
TOUCHED_BITS = 26
PAGE = 1024
#: Stands for a null id: after all others.
LAST = 2**63 - 1


def word_codes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    return mix64(out)


def minimisers(codes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The smallest hash of gram words in each window."""
    grams = _grams(codes, gram)
    n = len(codes) - window + 1
    least = grams[:n].copy()
    for k in range(1, window - gram + 1):
        np.minimum(least, grams[k : k + n], out=least)
    return least


class FmIndex:
    """FM-index of sequences of words, for patterns of at most 16 words."""

    def __init__(self, sequences: list[list[bytes]]):
        known: dict[bytes, int] = {}
        symbols = np.fromiter((known.setdefault(w, len(known)) for s in sequences for w in s), np.int64)
        self.alphabet = len(known)
        lengths = np.asarray([len(s) for s in sequences])
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.int64)  # 0 ends each sequence
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = symbols + 1
        self.text, self.starts = text, np.concatenate([[0], ends[:-1] + 1])
        n = len(text)
        rank = text.copy()
        for step in (1, 2, 4, 8):  # orders suffixes by 2, 4, 8 and 16 symbols
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1 if step < n else 0
            key = rank * (n + self.alphabet + 3) + after
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        self.order = order
        bwt = text[order - 1]
        counts = np.bincount(text, minlength=self.alphabet + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # wavelet matrix: a bit vector for each bit of a symbol, highest first, packed into 64-bit words with counts
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits = max(1, self.alphabet.bit_length())
        for level in range(self.bits - 1, -1, -1):
            bit = (bwt >> level) & 1
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, ones, n - int(bit.sum())))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        self.first = self._walk(np.arange(self.alphabet + 1), np.zeros(self.alphabet + 1, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (words, ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            word = at >> 6
            part = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            upto = ones[word] + np.bitwise_count(part)
            at = np.where((symbols >> level) & 1, zeros + upto, at - upto)
        return at

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        base = self.before[symbols] - self.first[symbols]
        return base + self._walk(symbols, low), base + self._walk(symbols, high)

    def intervals(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the patterns of that length that end at positions ends of the text."""
        symbols = self.text[ends]
        low, high = self.before[symbols], self.before[symbols + 1]
        for k in range(1, length):
            low, high = self.step(self.text[ends - k], low, high)
        return low, high


def least_holders(segments: list[list[bytes]], holders: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each segment, for each of its windows: the smallest holder of any segment that contains the window."""
    index = FmIndex(segments)
    number = np.asarray([len(s) - window + 1 for s in segments])
    ends = np.concatenate([np.arange(a + window - 1, a + window - 1 + n) for a, n in zip(index.starts, number, strict=True)])
    low, high = index.intervals(ends, window)
    by_suffix = holders[np.searchsorted(index.starts, index.order, "right") - 1]
    # windows that are equal have one interval, others' intervals do not touch it
    starts, back = np.unique(low, return_inverse=True)
    stops = np.empty(len(starts), np.int64)
    stops[back] = high
    pairs = np.stack([starts, stops], axis=1).ravel()
    least = np.minimum.reduceat(np.append(by_suffix, np.iinfo(np.int64).max), pairs)[::2]
    return np.split(least[back], np.cumsum(number)[:-1])


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.col("text").cast("string").alias("text"))


def _digest(words: list[bytes]) -> int:
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(b" ".join(words))).view(np.int64))


def _minimisers(docs: DataFrame) -> DataFrame:
    """doc_id, a digest of the words, the distinct minimisers, of documents with a window."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, lists = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= WINDOW:
                    ids.append(doc_id)
                    digests.append(_digest(words))
                    lists.append(np.unique(minimisers(word_codes(words))).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "digest", "least"])

    return _base(docs).mapInArrow(found, "doc_id long, digest long, least array<long>")


def _copies(docs: DataFrame) -> DataFrame:
    """Ids of documents whose word sequence (at least a window) a smaller id has too. SHA-256 stands for the sequence."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= WINDOW:
                    ids.append(doc_id)
                    out.append(hashlib.sha256(b" ".join(words)).digest()[:16])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "digest"])

    rows = cut(_base(docs).mapInArrow(digests, "doc_id long, digest binary"))
    firsts = cut(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    return rows.join(firsts, "digest").filter("doc_id <> first").select("doc_id").distinct()


@functools.lru_cache(maxsize=1)
def _tables(folder: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tables of a written filter; a Python worker reads them once."""
    repeated, hot = (np.zeros(max(1, 1 << bits >> 6), np.uint64) for _ in range(2))
    fs, path = opened(folder)
    for info in fs.get_file_info(pafs.FileSelector(path)):
        if info.type != pafs.FileType.File or info.base_name.startswith(("_", ".")):
            continue
        with fs.open_input_file(info.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=1 << 16):
                at = batch.column("w").to_numpy()
                repeated[at] = batch.column("r").to_numpy().view(np.uint64)
                hot[at] = batch.column("h").to_numpy().view(np.uint64)
    return repeated, hot


class Filter:
    """Two Bloom filters over minimisers in tables of 64-bit words: those that repeat, and the hot ones among them.

    The words lie in a folder of the shared store, and only tasks read them; this object is its address.
    """

    shifts = (0, 15, 30)

    def __init__(self, bits: int, folder: str):
        self.bits, self.mask, self.folder = bits, (1 << bits) - 1, folder

    @property
    def repeated(self) -> np.ndarray:
        return _tables(self.folder, self.bits)[0]

    @property
    def hot(self) -> np.ndarray:
        return _tables(self.folder, self.bits)[1]

    def holds(self, table: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for s in self.shifts:
            at = (values >> np.uint64(s)) & np.uint64(self.mask)
            out &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def filter_of(least: DataFrame, n_docs: int, hot: int = HOT) -> Filter:
    """least: doc_id, digest, least. Bits are set by aggregation; at most 2**bits / 64 words are written, none reaches the driver."""
    spark = least.sparkSession
    shared_checkpoints(spark)
    bits = min(max((64 * max(n_docs, 1)).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    out = Filter(bits, f"{spark.sparkContext.getCheckpointDir()}/filter-{uuid.uuid4().hex}")
    each = least.select("digest", F.explode("least").alias("m")).groupBy("m").agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count("*").alias("n")).filter("a <> b")
    at = F.explode(F.array(*(F.shiftrightunsigned("m", s).bitwiseAND(F.lit(out.mask)) for s in Filter.shifts))).alias("at")
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = each.select(at, (F.col("n") > hot).alias("is_hot")).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(bit).alias("r"), F.bit_or(F.when(F.col("is_hot"), bit).otherwise(F.lit(0).cast("long"))).alias("h"))
    words.write.parquet(out.folder)
    return out


def _segments(docs: DataFrame, known: Filter, words_too: bool) -> DataFrame:
    """Segments of the documents: key (what deals them), doc_id, start, segment (a hash) and, if asked for, their words."""
    kinds = {"key": pa.int64(), "doc_id": pa.int64(), "start": pa.int32(), "segment": pa.int64(), "words": pa.binary()}
    if not words_too:
        kinds.pop("words")

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        repeated, hot = known.repeated, known.hot
        for batch in batches:
            out: dict[str, list] = {k: [] for k in kinds}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if len(words) < WINDOW:
                    continue
                least = minimisers(word_codes(words))
                wanted = known.holds(repeated, least)
                if not wanted.any():
                    continue
                alone = known.holds(hot, least) & wanted
                breaks = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | alone[1:] | alone[:-1]]))
                ends = np.append(breaks[1:], len(least))
                for a, b in zip(breaks[wanted[breaks]].tolist(), ends[wanted[breaks]].tolist(), strict=True):
                    data = b" ".join(words[a : b + WINDOW - 1])
                    own = xxh3_64_intdigest(data) - 2**63
                    out["key"].append(own if alone[a] else int(least[a].view(np.int64)))
                    out["doc_id"].append(doc_id)
                    out["start"].append(a)
                    out["segment"].append(own)
                    if words_too:
                        out["words"].append(data)
            yield pa.RecordBatch.from_arrays([pa.array(out[k], kind) for k, kind in kinds.items()], names=list(kinds))

    return _base(docs).mapInArrow(segmented, "key long, doc_id long, start int, segment long" + ", words binary" * words_too)


def _searched(pdf: pd.DataFrame) -> pd.DataFrame:
    found = least_holders([x.split() for x in pdf["words"]], pdf["doc_id"].to_numpy())
    return pd.DataFrame({"segment": pdf["segment"], "least": [x.tolist() for x in found]})


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, first and n of every run of windows in a place that an earlier document holds too."""
    for batch in batches:
        doc_ids, starts, lists = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy(), batch.column("least")
        sizes = np.diff(lists.offsets.to_numpy())
        place = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        held = lists.flatten().to_numpy(zero_copy_only=False) < doc_ids[place]
        edge = np.concatenate([[True], (place[1:] != place[:-1]) | (held[1:] != held[:-1])]) if len(place) else np.empty(0, bool)
        at = np.flatnonzero(edge)
        n = np.diff(np.append(at, len(place)))
        at, n = at[held[at]], n[held[at]]
        yield pa.RecordBatch.from_arrays([pa.array(doc_ids[place[at]], pa.int64()), pa.array((starts[place[at]] + inside[at]).astype(np.int32)), pa.array(n.astype(np.int32))], names=["doc_id", "first", "n"])


def covered_windows(docs: DataFrame) -> DataFrame:
    """doc_id and ranges (first, n) of its windows that also start in a document with a smaller id."""
    spark = docs.sparkSession
    small_batches(spark)
    n_docs = docs.count()
    known = filter_of(_minimisers(docs), n_docs)
    shards = max(1, -(-n_docs // SHARD))
    distinct = (
        _segments(docs, known, True).groupBy("segment", "words").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"))
        .select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "segment", "words", "doc_id")
    )
    answers = distinct.groupBy("shard").applyInPandas(_searched, "segment long, least array<long>")
    places = _segments(docs, known, False).select("segment", "doc_id", "start").join(answers, "segment")
    found = places.select("doc_id", "start", "least").mapInArrow(_ranges, "doc_id long, first int, n int")
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "n")).alias("ranges"))


def _kept(texts: DataFrame) -> DataFrame:
    """texts: doc_id, text, ranges (null: none), copy (true: nothing is left)."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, kept = [], [], []
            for text, ranges, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "ranges", "copy")), strict=True):
                words = words_of(text)
                left = words
                if copy:
                    left = []
                elif ranges:
                    lost = bytearray(len(words))
                    for r in ranges:
                        first, end = r["first"], min(r["first"] + r["n"] + WINDOW - 1, len(words))
                        lost[first:end] = b"\1" * (end - first)
                    left = [w for w, x in zip(words, lost, strict=True) if not x]
                sizes.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    return texts.select("doc_id", "text", "ranges", "copy").mapInArrow(done, "doc_id long, n_words long, n_removed long, text string")


def _marked(docs: DataFrame, facts: DataFrame, bits: int) -> DataFrame:
    """docs plus touched: true for every document of facts, and for the few others whose bit is set as well."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits))
    with_bit = lambda df: df.withColumn("__word", F.shiftright(slot, 6)).withColumn("__bit", F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))"))
    page = F.floor(F.col("__word") / PAGE).alias("__page")

    # every word stands in its page, so that one is found by its place; a broadcast of single words takes several times the memory
    def paged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        words = np.zeros(PAGE, np.int64)
        np.bitwise_or.at(words, rows.column("__word").to_numpy() % PAGE, rows.column("__bit").to_numpy())
        return pa.table({"__page": pa.array([key[0].as_py()], pa.int64()), "__sets": pa.array([words], pa.list_(pa.int64()))})

    table = cut(with_bit(facts).select(page, "__word", "__bit").groupBy("__page").applyInArrow(paged, "__page long, __sets array<long>"))
    held = with_bit(docs).withColumn("__page", page).join(F.broadcast(table), "__page", "left")
    return held.withColumn("touched", F.coalesce(F.get("__sets", (F.col("__word") % PAGE).cast("int")).bitwiseAND(F.col("__bit")) != 0, F.lit(False))).drop("__sets")


def deduplicate(docs: DataFrame, *, touched_bits: int = TOUCHED_BITS) -> DataFrame:
    """doc_id, n_words, n_removed and the text left (words joined by one space) of every row of docs."""
    covered = covered_windows(docs)
    copies = _copies(docs).select("doc_id", F.lit(True).alias("copy"))
    facts = covered.join(copies, "doc_id", "full").select("doc_id", F.when(F.col("copy").isNull(), F.col("ranges")).alias("ranges"), F.coalesce("copy", F.lit(False)).alias("copy"))
    facts = cut(facts)
    marked = _marked(_base(docs), facts, touched_bits)
    untouched = marked.filter(~F.col("touched")).select("doc_id", "text", F.lit(None).cast(facts.schema["ranges"].dataType).alias("ranges"), F.lit(False).alias("copy"))
    touched = marked.filter("touched").select("doc_id", "text").join(facts, "doc_id", "left")
    out = _kept(untouched).unionByName(_kept(touched))
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM w WHERE len(words) >= 13)
), first AS (SELECT k, min(doc_id) AS lo FROM g GROUP BY k),
hit AS (SELECT DISTINCT doc_id, s + unnest(range(0, 13)) AS p FROM g JOIN first USING (k) WHERE lo < doc_id),
cut AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(ps), 0) AS n_removed, words, coalesce(ps, []) AS ps FROM w LEFT JOIN cut ON w.doc_id = cut.doc_id
), flat AS (
  SELECT doc_id, u.i AS i, words[u.i] AS x FROM (SELECT doc_id, words, unnest(list_transform(range(1, len(words) + 1), lambda y: {'i': y})) AS u FROM kept)
), joined AS (
  SELECT flat.doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM flat LEFT JOIN hit ON flat.doc_id = hit.doc_id AND flat.i = hit.p WHERE hit.p IS NULL GROUP BY flat.doc_id
)
SELECT kept.doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM kept LEFT JOIN joined ON kept.doc_id = joined.doc_id
"""
