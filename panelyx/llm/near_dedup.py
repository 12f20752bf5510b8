"""Near-duplicate detection with HyperMinHash sketches (operator 3).

Each text becomes the set of hashes of its distinct 5-word shingles (lower-cased A-Z; a shorter text is one shingle).
A sketch has ``BUCKETS`` registers of 16 bits. Bucket b keeps the smallest value of its own permutation of the
hashes, as the number of leading zeros and the ten mantissa bits that follow. (One permutation per bucket, since
splitting one permutation over the buckets would leave most of them empty for short texts.) Bands of four registers
are exactly one long.

1. Texts with equal sets collapse to one representative, the one with the smallest id.
2. Representatives that share a band's registers are candidates. In every band bucket the member with most
   candidates is the centre, and the others are compared with it only: no bucket emits its pairs.
3. The Jaccard index estimated from the registers, corrected for chance collisions of compressed registers, drops
   hopeless pairs; the rest are confirmed on full shingle sets, with a hot centre's set salted over many tasks.
4. Components of the confirmed links follow. Wherever a bucket still holds several components, the members outside
   the centre's component are compared with all members, in blocks of bounded size: first by sketches, then on full
   sets inside the block, which returns at most one link for each member and component. So links between two
   members that are not linked with the centre are found too.
5. Components of all links give component_id; members of a collapsed class share it.

A pair at the threshold meets in no band with probability (1 - 0.85**4)**32 < 1e-10.

Defined results: texts without words have an empty set and stand alone; a null doc_id is linked with nothing and
kept; rows that share doc_id are one document, and each gets its component; an empty table gives an empty result;
columns other than doc_id and text are ignored by :func:`near_groups` and returned as they are by :func:`deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_words_of, mix64, shuffle_partitions, small_batches
from .components import components

SHINGLE = 5
BANDS, WIDTH = 32, 4
BUCKETS = BANDS * WIDTH
MANTISSA = 10
BLOCK = 256
#: Up to so many ids are broadcast to pick documents by; beyond it the documents are shuffled to the ids.
BROADCAST_IDS = 200_000
#: Odd multipliers and offsets of the buckets' permutations.
_MULTIPLY, _ADD = (mix64(np.arange(1 + k * BUCKETS, 1 + (k + 1) * BUCKETS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in (0, 1))
_MULTIPLY |= np.uint64(1)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles."""
    from xxhash import xxh3_64_intdigest

    words = lower_words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    return np.unique(mix64(out))


def registers(hashes: np.ndarray) -> np.ndarray:
    """BUCKETS registers: leading zeros (6 bits), then mantissa bits. A float's exponent and mantissa are just these."""
    least = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        values = hashes[at : at + 2048, None] * _MULTIPLY[None, :]
        values += _ADD[None, :]
        np.minimum(least, values.min(axis=0), out=least)
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.clip(1086 - (bits >> np.uint64(52)).astype(np.int64), 0, 63)
    return ((zeros << MANTISSA) | ((bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)).astype(np.uint16)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bands (null for an empty set)."""
    small_batches(docs.sparkSession)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_set(text)
                sizes.append(len(hashes))
                digests.append(xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(registers(hashes).view(np.int64) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(sketched, "doc_id long, n_shingles long, digest binary, bands array<long>")


def estimated_jaccard(a: Column, b: Column, n: Column, m: Column) -> Column:
    """From the share of equal registers, corrected for the chance that different minima look alike when compressed.

    The expected share of such collisions is 0.1699 * 2**-MANTISSA * 4 r / (1 + r)**2 with r the ratio of the sizes.
    """
    lanes = lambda x: sum((x.bitwiseAND(F.lit(np.int64(np.uint64(0xFFFF << 16 * k)).item())) == 0).cast("int") for k in range(WIDTH))
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: lanes(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    ratio = n / m
    chance = F.lit(0.1699 * 2.0**-MANTISSA) * 4 * ratio / ((1 + ratio) * (1 + ratio))
    return (equal / F.lit(float(BUCKETS)) - chance) / (1 - chance)


def _least_estimate(threshold: float) -> float:
    """Six standard deviations under the threshold."""
    return threshold - 6 * (threshold * (1 - threshold) / BUCKETS) ** 0.5


def intersections(a: list[np.ndarray], b: list[np.ndarray], slice_columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections of two blocks of sorted sets, by products of 0-1 matrices over slices of the hashes."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return out
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        at = np.searchsorted(both, values)
        held = (at < len(both)) & (both[np.minimum(at, max(len(both) - 1, 0))] == values) if len(both) else np.zeros(len(values), bool)
        order = np.argsort(at[held], kind="stable")
        return rows[held][order], at[held][order]

    (ra, ca), (rb, cb) = places(a), places(b)
    for low in range(0, len(both), slice_columns):
        x, y = np.zeros((len(a), slice_columns), np.float32), np.zeros((len(b), slice_columns), np.float32)
        for m, rows, columns in ((x, ra, ca), (y, rb, cb)):
            i, j = np.searchsorted(columns, [low, low + slice_columns])
            m[rows[i:j], columns[i:j] - low] = 1
        out += x @ y.T
    return out


def _similar(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    both = intersections(a, b).astype(np.int64)
    sizes = np.asarray([len(s) for s in a])[:, None] + np.asarray([len(s) for s in b])[None, :]
    return 100 * both >= percent * (sizes - both)


def _sets_of(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _with_sets(docs: DataFrame, needed: DataFrame, key: str) -> DataFrame:
    """needed (doc_id and a list of structs in column places) with each document's shingle set, one row for each place.

    key: type of the structs' fields, which become the columns.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = [x.split()[0] for x in key.split(", ")]
    if needed.count() <= BROADCAST_IDS:
        # ids alone are broadcast; places may be long lists and follow in a join of the few documents left
        texts = texts.join(F.broadcast(needed.select("doc_id")), "doc_id", "left_semi")
    small_batches(spark)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("places"), pa.array(sets, pa.binary())], names=["doc_id", "places", "hashes"])

    typed = needed.schema["places"].dataType.simpleString()
    rows = texts.join(needed, "doc_id").select("doc_id", "text", "places").mapInArrow(hashed, f"doc_id long, places {typed}, hashes binary")
    return rows.select("doc_id", "hashes", F.explode("places").alias("p")).select("doc_id", "hashes", *(F.col(f"p.{f}") for f in fields))


def _confirmed_with_centres(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b = centre) whose full sets are similar enough."""
    degree = cut(pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")))
    salted = pairs.join(degree, "b").select(F.col("a").alias("doc_id"), F.col("b").alias("centre"), F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("is_centre"))
    own = degree.select(F.col("b").alias("doc_id"), F.col("b").alias("centre"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("is_centre"))
    needed = cut(salted.unionByName(own).groupBy("doc_id").agg(F.collect_list(F.struct("centre", "part", "is_centre")).alias("places")))

    def confirmed(pdf: pd.DataFrame) -> pd.DataFrame:
        centre = pdf[pdf["is_centre"] == 1]
        rest = pdf[pdf["is_centre"] == 0]
        if not len(centre) or not len(rest):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        held = _similar(_sets_of(rest["hashes"]), _sets_of(centre["hashes"][:1]), percent)[:, 0]
        return pd.DataFrame({"a": rest["doc_id"][held].to_numpy(), "b": centre["doc_id"].iloc[0]})

    return _with_sets(docs, needed, "centre long, part int, is_centre int").groupBy("centre", "part").applyInPandas(confirmed, "a long, b long")


def _members_in_blocks(groups: DataFrame) -> DataFrame:
    """groups (g, id, inside: in the centre's component) dealt over pairs of blocks: columns g, i, j, id, first.

    Members outside (first) of block i meet all members of block j.
    """
    sizes = cut(groups.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("all_parts"), F.ceil(F.count_if(~F.col("inside")) / BLOCK).cast("int").alias("out_parts")).filter("out_parts > 0"))
    dealt = cut(groups).join(sizes, "g")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    first = dealt.filter("not inside").select("g", block("out_parts").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)).alias("j"), "id", F.lit(1).alias("first"))
    every = dealt.select("g", F.explode(F.sequence(F.lit(0), F.col("out_parts") - 1)).alias("i"), block("all_parts").alias("j"), "id", F.lit(0).alias("first"))
    return first.unionByName(every)


def _links_in_groups(docs: DataFrame, groups: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Links of members outside the centre's component with any member of another component of their group."""
    least = _least_estimate(percent / 100)
    facts = groups.select("id", "component_id").distinct()
    places = cut(_members_in_blocks(groups.select("g", "id", "inside")))
    drawn = cut(places.join(cut(facts.join(sketch.select(F.col("doc_id").alias("id"), "n_shingles", "bands"), "id")), "id"))

    def hopeful(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["first"] == 1], pdf[pdf["first"] == 0]
        keep_x, keep_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
        if len(x) and len(y):
            ry = np.stack(y["bands"].to_numpy()).astype(np.int64).view(np.uint16)
            ny, cy = y["n_shingles"].to_numpy(), y["component_id"].to_numpy()
            for k, (bands, n, c) in enumerate(zip(x["bands"], x["n_shingles"], x["component_id"], strict=True)):
                equal = (ry == np.asarray(bands, np.int64).view(np.uint16)[None, :]).mean(axis=1)
                ratio = n / ny
                chance = 0.1699 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
                held = ((equal - chance) / (1 - chance) >= least) & (cy != c) & (100 * np.minimum(n, ny) >= percent * np.maximum(n, ny))
                keep_x[k] = held.any()
                keep_y |= held
        return pd.concat([x[keep_x], y[keep_y]])[["g", "i", "j", "id", "first", "component_id"]]

    kept = cut(drawn.groupBy("g", "i", "j").applyInPandas(hopeful, "g long, i int, j int, id long, first int, component_id long"))
    needed = cut(kept.groupBy(F.col("id").alias("doc_id")).agg(F.collect_list(F.struct("g", "i", "j", "first", "component_id")).alias("places")))

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["first"] == 1].sort_values("doc_id"), pdf[pdf["first"] == 0].sort_values("doc_id")
        out: list[tuple[int, int]] = []
        if len(x) and len(y):
            similar = _similar(_sets_of(x["hashes"]), _sets_of(y["hashes"]), percent)
            yc, yi = y["component_id"].to_numpy(), y["doc_id"].to_numpy()
            similar &= x["component_id"].to_numpy()[:, None] != yc[None, :]
            for k, a in enumerate(x["doc_id"].tolist()):
                own = np.flatnonzero(similar[k])
                # one link for each component met: the rest would join the same components again
                out += [(a, int(yi[own[t]])) for t in np.unique(yc[own], return_index=True)[1]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _with_sets(docs, needed, "g long, i int, j int, first int, component_id long").groupBy("g", "i", "j").applyInPandas(linked, "a long, b long")


def near_groups(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept. Links need 100 * intersection >= percent * union."""
    salts = 4 * shuffle_partitions(docs.sparkSession)
    sketch = cut(sketches(docs))
    shingled = sketch.filter("n_shingles > 0 and doc_id is not null")
    reps = cut(shingled.groupBy("digest").agg(F.min("doc_id").alias("rep")))
    # equal sets meet their representative over salts, so that a set which very many documents share stays spread
    salted = shingled.select("doc_id", "n_shingles", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    members = salted.join(salted.select("digest", "salt").distinct().join(reps, "digest"), ["digest", "salt"]).select("doc_id", "n_shingles", "rep")
    own = cut(sketch.join(reps.select(F.col("rep").alias("doc_id"), F.col("digest").alias("d")), "doc_id").filter("digest = d").select("doc_id", "n_shingles", "bands").dropDuplicates(["doc_id"]))

    banded = own.select("doc_id", F.posexplode("bands").alias("band", "value")).select("doc_id", F.xxhash64("band", "value").alias("key"))
    shared = cut(banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    rows = cut(banded.join(shared, "key"))
    degrees = cut(rows.groupBy("doc_id").agg(F.sum("size").alias("degree")))
    centres = cut(rows.join(degrees, "doc_id").groupBy("key").agg(F.max_by(F.struct("doc_id"), F.struct("degree", -F.col("doc_id"))).alias("c")).select("key", F.col("c.doc_id").alias("centre")))
    held = cut(rows.select("key", "doc_id").join(centres, "key").select("centre", "doc_id").distinct())

    sizes = own.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("bands").alias("other"))
    pairs = (
        held.filter("centre <> doc_id").select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))
        .join(own.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), "bands"), "a")
        .filter("true").join(sizes, "b")
        .filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        .filter(estimated_jaccard(F.col("bands"), F.col("other"), F.col("n"), F.col("m")) >= _least_estimate(percent / 100))
        .select("a", "b")
    )
    links = cut(_confirmed_with_centres(docs, cut(pairs), percent))
    found = components(links)

    # groups: members of all buckets whose centres are in one component
    label = lambda name: found.select(F.col("id").alias(name), F.col("component_id").alias(f"{name}_c"))
    grouped = (
        held.join(label("centre"), "centre", "left").join(label("doc_id"), "doc_id", "left")
        .select(F.coalesce("centre_c", "centre").alias("g"), F.col("doc_id").alias("id"), F.coalesce("doc_id_c", "doc_id").alias("component_id")).distinct()
        .withColumn("inside", F.col("g") == F.col("component_id"))
    )
    grouped = cut(grouped)
    # a group of two components with one member outside has been settled by the centre only if the centre is all there is
    mixed = cut(grouped.groupBy("g").agg(F.count_if(~F.col("inside")).alias("outside"), F.count("*").alias("n")).filter("outside > 0 and n > 2").select("g"))
    if not mixed.isEmpty():
        more = cut(_links_in_groups(docs, cut(grouped.join(mixed, "g")), own, percent))
        if not more.isEmpty():
            found = components(links.unionByName(more))

    whole = members.join(found.select(F.col("id").alias("rep"), F.col("component_id").alias("c")), "rep", "left").select("doc_id", "n_shingles", F.coalesce("c", "rep").alias("component_id"))
    alone = sketch.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """docs without the rows whose document is not its component's smallest id; all columns of docs and no others."""
    gone = near_groups(docs, percent=percent).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
