"""Exact deduplication by skew-safe combining (operator 4), in DataFrame operations only.

Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``. Three stages, each of
which groups by the digest *and* the full normalised content:

1. every task combines its own rows (the partial aggregate, before any shuffle);
2. rows of a digest meet in one of many salted groups, so a text that a third of all rows share is spread;
3. the salts' winners, at most one for each salt and text, are combined for the whole table.

The verdict returns to the rows over the same salts: salted groups learn it first, then rows ask their own
salted group, so no join key holds more than a salt's share of a hot text.

Defined results: a null text is empty; an empty text equals other empty or all-white texts; a null doc_id loses
to any other and keeps as null; rows that repeat doc_id and text count in group_size and share the verdict
(:func:`deduplicate` returns one of them); an empty table gives an empty result; columns besides the id and the
text are never touched, whatever their names. If two different contents had the same SHA-256 digest, length and
64-bit hash, the job stops with an error and gives no wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, without_white

_SHIFT, _TOP = 2**65, 2**63


def _whole(x: int) -> Column:
    return F.lit(str(x)).cast("decimal(20,0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """Most code points first, then the smallest doc_id, then null: one decimal, so that hash aggregation takes it."""
    order = F.coalesce(_whole(_TOP) - doc_id.cast("decimal(20,0)"), _whole(0))
    return (n_chars.cast("decimal(12,0)") * _whole(_SHIFT) + order).cast("decimal(38,0)")


def _winner(rank: Column) -> Column:
    order = rank % _whole(_SHIFT)
    return F.when(order > 0, _whole(_TOP) - order).cast("long")


def _judged(docs: DataFrame, id_col: str, text_col: str, salts: int | None) -> DataFrame:
    """One row per row of docs: doc_id, digest, keep_id, keep_n (code points of the text that stays), group_size."""
    salts = salts or 4 * shuffle_partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t")).select(
        "doc_id", F.char_length("t").alias("n"), without_white(F.col("t")).alias("content")
    )
    rows = rows.select(
        "doc_id", "n", "content",
        F.unhex(F.sha2("content", 256)).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    key = ["digest", F.xxhash64("content").alias("check"), F.octet_length("content").alias("octets")]
    members = rows.select("doc_id", "salt", *key)

    merged = rows.groupBy("digest", "content", "salt").agg(F.max(_rank(F.col("n"), F.col("doc_id"))).alias("rank"), F.count("*").alias("size"))
    texts = merged.groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("size").alias("size"))
    names = ["digest", "check", "octets"]
    verdicts = (
        texts.select(*key, "rank", "size")
        .groupBy(*names)
        .agg(F.max("rank").alias("rank"), F.max("size").alias("size"), F.count("*").alias("contents"))
        .select(*names, _winner(F.col("rank")).alias("keep_id"), F.floor(F.col("rank") / _whole(_SHIFT)).cast("int").alias("keep_n"), F.when(F.col("contents") > 1, F.raise_error(F.lit("two contents share a digest")).cast("long")).otherwise(F.col("size")).alias("group_size"))
    )
    salted = members.select(*names, "salt").distinct().join(verdicts, names)
    return members.join(salted, [*names, "salt"]).select("doc_id", "digest", "keep_id", "keep_n", "group_size")


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. salts: 4 for each shuffle partition unless given."""
    return _judged(docs, id_col, text_col, salts).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """docs with one row of every group of equal texts; all columns of docs and no others.

    A digest has one winner, so id, length and digest together name a group: rows are shuffled once, by the keys of the join,
    and the repeats of a winning row are dropped where they lie.
    """
    prefix = "__own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    own, won = ([f"{prefix}_{side}_{c}" for c in ("id", "null", "n", "digest")] for side in ("row", "winner"))
    named = lambda names, id_, n, digest: [c.alias(x) for c, x in zip((F.coalesce(id_, F.lit(0)), id_.isNull(), n, digest), names, strict=True)]
    judged = _judged(docs, id_col, text_col, salts).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    winners = judged.select(*named(won, F.col("doc_id"), F.col("keep_n"), F.col("digest")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # never null, and said so: the join needs no filter that would take the digest twice
    digest = F.coalesce(F.unhex(F.sha2(without_white(text), 256)), F.lit(b""))
    rows = docs.select("*", *named(own, F.col(id_col).cast("long"), F.char_length(text), digest))
    return rows.join(winners, [rows[a] == winners[b] for a, b in zip(own, won, strict=True)], "left_semi").dropDuplicates(own).drop(*own)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The pattern deletes the six separators; DuckDB's length() counts code points.
ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents
), w AS (
  SELECT doc_id, sha256(c) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY c ORDER BY n DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY c) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM w
"""
