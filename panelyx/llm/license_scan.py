"""Licence scans by canonical digest lookup (operator 6), in DataFrame operations only.

A text is brought to canonical form: lower case, lines that are copyright notices out, punctuation and white space to
single spaces, equivalent spellings made one. The digest of the *entire* canonical text is then hash-joined with the
digests of known licence texts. Both the whole document and each of its lines are looked up, as a licence may be a
document or a notice inside one. The known table is small and fixed (its size does not depend on the documents), so
it is broadcast; texts are never shuffled, only the digests of documents meet what their lines matched.

Defined results: null, empty and all-punctuation texts match nothing; a text equal to several licences' canonical
forms gets the first by name; repeated rows are scanned one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .license_texts import DIGESTS, KNOWN

#: Spellings that count as equal in licence texts, in canonical form; each stands for the beginning of a word.
EQUIVALENT = [
    ("licence", "license"), ("sublicence", "sublicense"), ("relicence", "relicense"), ("licencing", "licensing"), ("sublicencing", "sublicensing"), ("licensor", "licenser"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("unauthorised", "unauthorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("fulfil ", "fulfill "), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("noncommercial", "non commercial"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme ", "program "), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"),
    ("whilst ", "while "), ("wilful", "willful"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("http ", "https "),
]

#: A line that is nothing but a copyright notice: its mark first, then a year somewhere, a second
#: mark or a placeholder right behind it, or next to nothing.
COPYRIGHT = r"^[^\p{L}\p{N}]*((copyright|©|\(c\)|all rights reserved)([^\n]*[0-9]{4}[^\n]*|[^\n]{0,20})|(copyright\s*(©|\(c\)|[<\[{])|©\s*[<\[{])[^\n]*)\z"
BETWEEN = r"[^\p{L}\p{N}]+"


def canonical_lines(text: Column) -> Column:
    """Lines in lower case, notices out, punctuation to spaces; spellings are then made equal in all lines at once, from the beginnings of words on."""
    line = lambda x: F.when(x.rlike(COPYRIGHT), F.lit("")).otherwise(F.trim(F.regexp_replace(x, BETWEEN, " ")))
    out = F.concat(F.lit(" "), F.array_join(F.transform(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "\n"), line), " \n "), F.lit(" "))
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(" " + a), F.lit(" " + b))
    return F.transform(F.split(out, "\n"), lambda x: F.trim(x))


def whole(lines: Column) -> Column:
    """The canonical form of a text from those of its lines."""
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_digests(spark, known: Iterable[tuple[str, str]] = tuple(KNOWN), digests: Iterable[tuple[str, str]] = tuple(DIGESTS)) -> DataFrame:
    """digest and license of each known text, one row for each digest. digests: (license, digest of the canonical text) of further texts."""
    texts = spark.createDataFrame(list(known), "license string, text string").select("license", whole(canonical_lines(F.col("text"))).alias("c")).filter("c <> ''").select("license", F.sha2("c", 256).alias("digest"))
    more = spark.createDataFrame(list(digests), "license string, digest string")
    return texts.unionByName(more).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: Iterable[tuple[str, str]] = tuple(KNOWN), digests: Iterable[tuple[str, str]] = tuple(DIGESTS)) -> DataFrame:
    """doc_id, text_digest, text_license (null: none), n_license_lines, licenses (of text and lines, sorted, by comma) of every row of docs."""
    table = known_digests(docs.sparkSession, known, digests)
    held = F.broadcast(table)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text")).alias("lines"))
    # digests alone are written, so that texts are read and made canonical once for both lookups
    rows = cut(rows.select("doc_id", F.sha2(whole(F.col("lines")), 256).alias("text_digest"), F.transform("lines", lambda x: F.unhex(F.sha2(x, 256))).alias("line_digests")))
    texts = rows.select("doc_id", "text_digest")
    lines = (
        rows.select("doc_id", "text_digest", F.posexplode("line_digests").alias("at", "line"))
        .join(F.broadcast(table.select(F.unhex("digest").alias("line"), "license")), "line")
        .groupBy("doc_id", "text_digest")
        .agg(F.count_distinct("at").alias("n"), F.collect_set("license").alias("found"))
        .select(F.col("doc_id").alias("d"), F.col("text_digest").alias("t"), "n", "found")
    )
    matched = texts.join(held.select(F.col("digest").alias("text_digest"), F.col("license").alias("text_license")), "text_digest", "left")
    both = F.array_sort(F.array_distinct(F.concat(F.coalesce("found", F.array()), F.when(F.col("text_license").isNotNull(), F.array("text_license")).otherwise(F.array()))))
    return matched.join(lines, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_digest") == F.col("t")), "left").select(
        "doc_id", "text_digest", "text_license", F.coalesce("n", F.lit(0)).alias("n_license_lines"), F.array_join(both, ",").alias("licenses")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle_sql(known: Iterable[tuple[str, str]] = tuple(KNOWN), digests: Iterable[tuple[str, str]] = tuple(DIGESTS)) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    line = f"CASE WHEN regexp_matches(x, {quoted(COPYRIGHT)}) THEN '' ELSE trim(regexp_replace(x, {quoted(BETWEEN)}, ' ', 'g')) END"
    spelled = f"' ' || array_to_string(list_transform(string_split(lower(coalesce(text, '')), chr(10)), lambda x: {line}), ' ' || chr(10) || ' ') || ' '"
    for a, b in EQUIVALENT:
        spelled = f"replace({spelled}, {quoted(' ' + a)}, {quoted(' ' + b)})"
    lines = f"list_transform(string_split({spelled}, chr(10)), lambda x: trim(x))"
    joined = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known)
    more = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in digests)
    return f"""
WITH k0(license, text) AS (VALUES {values}), k1(license, digest) AS (VALUES {more}),
k AS (SELECT digest, min(license) AS license FROM (SELECT license, sha256({joined}) AS digest FROM (SELECT license, {lines} AS lines FROM k0) WHERE {joined} <> '' UNION ALL SELECT license, digest FROM k1) GROUP BY 1),
d AS (SELECT doc_id, lines, sha256({joined}) AS text_digest FROM (SELECT doc_id, {lines} AS lines FROM documents)),
u AS (SELECT doc_id, sha256(l) AS digest FROM (SELECT doc_id, unnest(lines) AS l FROM d)),
f AS (SELECT doc_id, count(*) AS n, list(DISTINCT license) AS found FROM u JOIN k USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.text_digest, k.license AS text_license, coalesce(n, 0) AS n_license_lines,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(found, []), CASE WHEN k.license IS NULL THEN [] ELSE [k.license] END))), ',') AS licenses
FROM d LEFT JOIN k ON d.text_digest = k.digest LEFT JOIN f ON d.doc_id = f.doc_id
"""
