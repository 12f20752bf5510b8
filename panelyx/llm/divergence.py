"""How far the sources of a language lie apart in their use of words (operator 11): two-dimensional tiling of group pairs.

Terms are runs of ASCII letters (lower-cased) and of characters beyond ASCII. A language keeps the terms that stand in
at least ``least_docs`` of its documents; a group (language, source) gives every kept term the smoothed share
p = 1 + floor(10**9 * (count + 5) / (N + 5 V)), in integers.

1. Tasks count terms of whole texts in dictionaries of bounded size; sums by (language, source, term) follow.
2. Kept terms are dealt over chunks of about ``chunk`` terms by a hash and numbered there; a group's shares in one chunk
   are one packed vector. Terms that a group lacks are not stored: they all have the group's own smallest share.
3. Groups are cut into blocks of ``block``. A vector of block x is sent to the tiles (min(x, y), max(x, y)) of all blocks y.
   A tile, for a run of ``stripe`` successive chunks, holds one chunk's vectors and its pairs' sums at a time, whatever
   the size of the vocabulary. The sums of all runs are added up by pair.

Defined results: null text, language and source are ''; a group without terms has all counts 0; a language without kept
terms has pairs of value 0 and no terms; rows that repeat count as documents of their own; an empty table gives an empty
result; columns other than the three are ignored, whatever their names; a language of one source has no pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_ASCII, cut, read, small_batches

LEAST_DOCS = 30
TOP_TERMS = 50
#: Bytes to terms: A-Z fall to a-z, other ASCII characters become spaces, bytes beyond ASCII stay.
_TERM_BYTES = bytes(c if c > 127 or 97 <= LOWER_ASCII[c] <= 122 else 32 for c in range(256)).translate(LOWER_ASCII)
_SLICE = 1 << 20
_ENTRIES = 200_000


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of about a megabyte at a time; slices end between terms."""
    at = 0
    while at < len(text):
        part = text[at : at + _SLICE].translate(_TERM_BYTES)
        end = len(part)
        if at + end < len(text):
            end = part.rfind(b" ") + 1
            while not end:  # a term longer than the slice
                part = text[at : at + 2 * len(part)].translate(_TERM_BYTES)
                end = len(part) if at + len(part) >= len(text) else part.rfind(b" ") + 1
        yield part[:end].split()
        at += end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lang, source, text to partial rows lang, source, term, n, docs; every group has a row with a null term, too."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}

    def rows() -> pa.RecordBatch:
        keys = [(*g, t, n, docs[t]) for g, (counts, docs) in groups.items() for t, n in ((None, 0), *counts.items())]
        lang, source, term, n, d = zip(*keys, strict=True) if keys else ((),) * 5
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()), pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["lang", "source", "term", "n", "docs"])

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
            own: Counter = Counter()
            for words in terms_of(text.as_buffer().to_pybytes()):
                own.update(words)
            counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            held -= len(counts)
            counts.update(own)
            docs.update(own.keys())
            held += len(counts)
            if held > _ENTRIES:
                yield rows()
                groups.clear()
                held = 0
    yield rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term); a null term stands for the group itself."""
    small_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    part = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return part.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, whole: str, v: str) -> F.Column:
    """1 + floor(10**9 * (n + 5) / (whole + 5 v)); decimals, as the product passes 64 bits."""
    return F.expr(f"CASE WHEN {v} > 0 THEN 1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 5 AS DECIMAL(20,0))) DIV CAST({whole} + 5 * {v} AS DECIMAL(20,0)) END")


def _sent(df: DataFrame, rows: int, most: int = 20_000) -> DataFrame:
    """df as a broadcast side, if its counted rows are few; else as it is, for a shuffled join that adaptive execution splits."""
    return F.broadcast(df) if rows <= most else df


class _Tile:
    """Sums of one tile over a run of chunks; the groups' own smallest shares come first."""

    def __init__(self, key: tuple) -> None:
        self.key, self.names, self.low, self.block = key, {}, {}, {}
        self.terms = self.covered = 0
        self.chunk: int | None = None
        self.vectors: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.sums: np.ndarray | None = None

    def header(self, g: int, name: str, low: int | None, block: int, terms: int) -> None:
        self.names[g], self.low[g], self.block[g], self.terms = name, low or 0, block, terms

    def sides(self) -> tuple[list[int], list[int]]:
        _, a, b, _ = self.key
        return [g for g in sorted(self.names) if self.block[g] == a], [g for g in sorted(self.names) if self.block[g] == b]

    def vector(self, chunk: int, g: int, places: np.ndarray, shares: np.ndarray) -> None:
        if chunk != self.chunk:
            self.close_chunk()
            self.chunk = chunk
        self.vectors[g] = places, shares

    def close_chunk(self) -> None:
        if not self.vectors:
            return
        rows, cols = self.sides()
        if self.sums is None:
            self.sums = np.zeros((len(rows), len(cols)), np.int64)
        used = np.unique(np.concatenate([p for p, _ in self.vectors.values()]))

        def dense(groups: list[int]) -> np.ndarray:
            out = np.repeat(np.array([[self.low[g]] for g in groups], np.int64), len(used), axis=1)
            for i, g in enumerate(groups):
                if g in self.vectors:
                    places, shares = self.vectors[g]
                    out[i, np.searchsorted(used, places)] = shares
            return out

        left, right = dense(rows), dense(cols)
        for i in range(len(rows)):
            self.sums[i] += np.abs(right - left[i]).sum(axis=1)
        self.covered += len(used)
        self.vectors = {}

    def pairs(self) -> Iterator[tuple[str, str, str, int]]:
        self.close_chunk()
        lang, a, b, _ = self.key
        rows, cols = self.sides()
        for i, x in enumerate(rows):
            for j, y in enumerate(cols):
                if a < b or x < y:
                    value = (self.terms - self.covered) * abs(self.low[x] - self.low[y]) + (int(self.sums[i, j]) if self.sums is not None else 0)
                    yield lang, self.names[x], self.names[y], value
                    yield lang, self.names[y], self.names[x], value


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by lang, a, b, run, chunk, g; headers have chunk -1."""

    def out(pairs: list[tuple]) -> pa.RecordBatch:
        lang, source, item, value = zip(*pairs, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], ["lang", "source", "item", "value"])

    tile: _Tile | None = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "a", "b", "run")), strict=True))
        chunk, g, source, low, block, terms = (batch.column(c).to_pylist() for c in ("chunk", "g", "source", "low", "block", "terms"))
        places, shares = batch.column("places"), batch.column("shares")
        for i, key in enumerate(keys):
            if tile is None or key != tile.key:
                if tile and (found := list(tile.pairs())):
                    yield out(found)
                tile = _Tile(key)
            if chunk[i] < 0:
                tile.header(g[i], source[i], low[i], block[i], terms[i])
            else:
                tile.vector(chunk[i], g[i], places[i].values.to_numpy(), shares[i].values.to_numpy())
    if tile and (found := list(tile.pairs())):
        yield out(found)


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.withColumn("rank", rank)
    rows = rows.filter(F.col("rank") <= most) if most else rows
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, chunk: int = 4096, stripe: int = 4, block: int = 8) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank.

    Pairs: every other source of the language with the summed difference of shares; terms: the top_terms terms that the
    source uses most beyond its language.
    """
    counts = cut(term_counts(docs))
    kept = cut(counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).filter(F.col("docs") >= least_docs).drop("docs"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("whole_lang"))
    n_langs, most = langs.agg(F.count("*"), F.coalesce(F.max("v"), F.lit(0))).first()
    chunks = max(1, -(-most // chunk))
    # the chunk is a hash of the term, its place there a number among some `chunk` rows
    vocabulary = kept.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int"))
    vocabulary = vocabulary.withColumn("place", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")).cast("int"))
    held = cut(counts.filter("term is not null").drop("docs").join(vocabulary, ["lang", "term"]))

    own = held.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    groups = counts.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(_sent(langs, n_langs), "lang", "left")
    groups = groups.fillna(0, ["whole", "v", "whole_lang"]).withColumn("low", _share("0", "whole", "v"))
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("g", numbered.cast("int")).withColumn("block", F.floor(F.col("g") / block).cast("int"))
    groups = cut(groups.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1))
    n_groups = groups.count()

    shares = held.join(_sent(groups, n_groups), ["lang", "source"]).withColumn("p", _share("n", "whole", "v"))
    tile = {"a": F.least("block", "other"), "b": F.greatest("block", "other")}
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    packed = shares.groupBy("lang", "chunk", "g", "block", "blocks").agg(F.sort_array(F.collect_list(F.struct("place", F.col("p").alias("share")))).alias("s"))
    vectors = packed.select("lang", "chunk", "g", "block", F.col("s.place").alias("places"), F.col("s.share").alias("shares"), each).withColumns(tile)
    vectors = vectors.select("lang", "a", "b", F.floor(F.col("chunk") / stripe).cast("int").alias("run"), "chunk", "g", F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("low"), "block", F.lit(0).cast("long").alias("terms"), "places", "shares")
    runs = vocabulary.groupBy("lang", F.floor(F.col("chunk") / stripe).cast("int").alias("run")).agg(F.count("*").alias("terms"))
    # run 0 exists in every language, so that all pairs do
    runs = runs.unionByName(groups.select("lang", F.lit(0).alias("run"), F.lit(0).cast("long").alias("terms")).distinct()).groupBy("lang", "run").agg(F.sum("terms").alias("terms"))
    headers = runs.join(_sent(groups, n_groups), "lang").select("*", each).withColumns(tile)
    none = F.array().cast("array<int>")
    headers = headers.select("lang", "a", "b", "run", F.lit(-1).alias("chunk"), "g", "source", "low", "block", "terms", none.alias("places"), none.cast("array<bigint>").alias("shares"))

    keys = ["lang", "a", "b", "run"]
    small_batches(docs.sparkSession, 200)
    dealt = headers.unionByName(vectors).repartition(*keys).sortWithinPartitions(*keys, "chunk", "g")
    partial = dealt.mapInArrow(_tiled, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    beyond = shares.withColumn("q", _share("n_lang", "whole_lang", "v")).filter("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(beyond, "term", top_terms))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS df FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(df) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS whole FROM k GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS n_lang FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
y AS (SELECT x.*, sum(x.n) OVER (PARTITION BY x.lang, x.source) AS own, v.v, v.whole FROM x JOIN v ON v.lang = x.lang),
z AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (own + 5 * v) AS p, 1 + (1000000000::HUGEINT * (n_lang + 5)) // (whole + 5 * v) AS q FROM y),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM z a JOIN z b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM z WHERE n > 0 AND p > q
), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
