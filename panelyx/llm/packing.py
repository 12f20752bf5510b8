"""Best-fit packing with certified bounds (operator 8).

Documents become token ids, an end id follows, and only documents longer than a sequence are cut. Pieces are then
packed: every partition runs best-fit decreasing over its own pieces, and dual feasible functions give a lower
bound that certifies its number of sequences. A certified partition gives its loosely filled sequences up for
exchange. One with a gap gives up as many of its loosest sequences as it takes for those that stay to be certified: what
they waste is less than one sequence, so that no packing of their pieces has fewer. Pieces given up are dealt anew to
fewer partitions and packed again, until one partition is left or the total meets the bound for the whole table. Every
partition of the first round holds at most ``part_rows`` pieces on average, so no task grows with the input; lengths of
the whole table reach the driver as a histogram of at most ``capacity`` rows.

Defined results: null and empty texts are one piece that holds the end id; repeated rows are packed once each;
an empty table gives an empty result; other columns are ignored. A text that spells one of the tokenizer's special
tokens gets that token's id, as the tokenizer gives it.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: The pattern, and the parts of a tokenizer file, for which ids of a text are those of its parts between white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordIds(dict):
    """ids (as little-endian unsigned 32-bit bytes) of text between white space, kept in two generations of bounded size.

    The normaliser and pattern above never look across white space, so a text's ids are those of its parts. Plain
    Latin parts go straight to the tokenizer's model; any other part goes through the tokenizer itself. A text that
    spells an added token goes through the tokenizer whole, and so does every text if the file has another normaliser
    or pattern.
    """

    def __init__(self, path: str, limit: int = 250_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = file.get("added_tokens") or []
        self.known = (
            file.get("normalizer") == NORMALIZER and file.get("pre_tokenizer") == PRE_TOKENIZER and file["model"].get("type") == "BPE"
            and not file.get("truncation") and not file.get("padding") and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in added)
        )
        # str.split() also cuts at four control characters that are no white space for the tokenizer
        self.apart = ("\x1c", "\x1d", "\x1e", "\x1f", *(t["content"] for t in added))
        self.limit, self.old, self.pre = limit, {}, {}
        self.plain = regex.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]+")
        self.pattern = regex.compile(PATTERN)
        # The byte alphabet of byte-level BPE: printable Latin-1 stands for itself, the others follow from U+0100.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def token(self, part: str) -> bytes:
        ids = self.pre.get(part)
        if ids is None:
            if len(self.pre) >= self.limit:
                self.pre.clear()
            symbols = part.encode().decode("latin-1").translate(self.alphabet)
            ids = self.pre[part] = np.asarray([t.id for t in self.model.tokenize(symbols)], "<u4").tobytes()
        return ids

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(part)
        if ids is None:
            if self.plain.fullmatch(part):
                low = unicodedata.normalize("NFC", part).lower()
                ids = self.token(low) if low.isalpha() else b"".join(map(self.token, self.pattern.findall(low)))
            else:
                ids = self.whole(part)
        self[part] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not self.known or any(c in text for c in self.apart):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache for each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of every document. path: a tokenizer file that the executors can open (None: asked for on each executor)."""
    small_batches(docs.sparkSession)
    end = np.asarray([end_id], "<u4").tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_ids(path or tokenizer_path())
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = memoryview(cache.ids(text or "") + end)
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut_up, PIECES)


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The best of two families of dual feasible functions over a histogram of sizes.

    First family, threshold t up to half the capacity: sizes above capacity - t count as full, those under t as nothing.
    Second family, k from 1: sizes round down to multiples of capacity / k, except multiples of capacity / (k + 1), which stay.
    """
    if not len(sizes):
        return 0
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    order = np.argsort(sizes)
    sizes, counts = sizes[order], counts[order]
    tokens = np.concatenate([[0], np.cumsum(sizes * counts)])
    number = np.concatenate([[0], np.cumsum(counts)])
    best = -(-int(tokens[-1]) // capacity)
    t = np.unique(np.minimum(sizes, capacity - sizes))
    t = t[(t >= 1) & (2 * t <= capacity)]
    low, high = np.searchsorted(sizes, t, "left"), np.searchsorted(sizes, capacity - t, "right")
    if len(t):
        full = number[-1] - number[high]
        best = max(best, int((full - (-(tokens[high] - tokens[low]) // capacity)).max()))
    for k in range(1, 25):
        whole = (sizes * (k + 1)) % capacity == 0
        rounded = np.where(whole, k * sizes, (sizes * (k + 1) // capacity) * capacity)  # k times the function's value
        best = max(best, -(-int((rounded * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and the bins' fills. A bit set of the free lengths in use finds the tightest bin that fits."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fills: list[int] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = free >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = waiting[room].pop()
            if not waiting[room]:
                free ^= 1 << room
        else:
            room, k = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = k, fills[k]
        fills[k] += size
        if left := room - size:
            if not waiting[left]:
                free |= 1 << left
            waiting[left].append(k)
    return bins, offsets, np.asarray(fills, np.int64)


def given_up(sizes: np.ndarray, fills: np.ndarray, capacity: int) -> np.ndarray:
    """Marks the bins that a partition gives up for exchange; the sum of the sizes certifies those that stay, or all were certified."""
    loose = fills < capacity - capacity // 64
    loose[fills.argmin()] = True
    if len(fills) > lower_bound(*np.unique(sizes, return_counts=True), capacity):
        order = np.argsort(-fills, kind="stable")
        kept = np.cumsum(capacity - fills[order]) < capacity  # fullest first, while all of them waste less than a bin
        loose[order[~kept]] = True
    return loose


def _packer(names: list[str], capacity: int, at: int, last: bool):
    """Packs one partition and marks what is to be exchanged."""

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["__part"].iloc[0])
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sizes = pdf["length"].to_numpy()
        bins, offsets, fills = best_fit_decreasing(sizes, capacity)
        again = np.zeros(len(pdf), bool) if last else given_up(sizes, fills, capacity)[bins]
        return pdf[names].assign(sequence_id=(at << 56) + (part << 28) + bins, offset=offsets, again=again, opens=(offsets == 0).astype(np.int32))

    return packed


def pack(rows: DataFrame, *, capacity: int = CAPACITY, part_rows: int = 10_000, rounds: int = 6) -> DataFrame:
    """rows (with a column length, at most capacity) plus sequence_id and offset."""
    names = rows.columns
    whole = cut(rows)
    histogram = whole.groupBy("length").count().toPandas()  # at most capacity rows
    least = lower_bound(histogram["length"].to_numpy(), histogram["count"].to_numpy(), capacity)
    n = int(histogram["count"].sum())
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in whole.schema)}, sequence_id long, offset long, again boolean, opens int"
    done: list[DataFrame] = []
    closed, todo, at = 0, whole, 0
    parts = max(1, -(-n // part_rows))
    while True:
        last = parts == 1 or at + 1 == rounds
        dealt = todo.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(at)), F.lit(parts)).cast("long"))
        out = cut(dealt.groupBy("__part").applyInPandas(_packer(names, capacity, at, last), schema))
        done.append(out.filter(~F.col("again")) if not last else out)
        if last:
            break
        made = out.agg(F.sum("opens").alias("bins"), F.coalesce(F.sum(F.when(~F.col("again"), F.col("opens"))), F.lit(0)).alias("closed"), F.count_if("again").alias("n")).first()
        if not made["n"] or closed + (made["bins"] or 0) == least:  # nothing to exchange, or certified for the whole table
            done[-1] = out
            break
        closed, at = closed + made["closed"], at + 1
        parts = max(1, min(parts // 2, -(-made["n"] // part_rows)))  # at most twice part_rows even if all was given up
        todo = out.filter("again").select(*names)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.drop("again", "opens")


def packed_documents(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path=path, capacity=capacity), capacity=capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
