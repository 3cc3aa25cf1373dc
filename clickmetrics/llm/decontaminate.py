"""Finding benchmark passages in documents by winnowing.

Both sides keep, of every ``WINDOW - GRAM + 1`` neighbouring hashes of word ``GRAM``-grams, the
smallest. Any ``WINDOW`` common words hold the same hashes, so the smallest of them is kept on both
sides and joins them: no shared span of that length is missed. Each joined fingerprint is then
extended to the windows around it, whose words are compared as text, so hashes never decide.

The benchmark side is an index of bounded size: its bytes are summed first, and beyond
``SLICE_BYTES`` it is dealt into slices, one pass over the documents for each, whose hits are merged.
Documents are not shuffled in the usual single pass. A task searches about ``SLAB_BYTES`` of text at a
time, so what it holds does not grow with the rows of a batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmetrics.llm.common import chain_hash, kept, map_batches, slabs, text_bytes, words_of

WINDOW = 10
GRAM = 5
SLICE_BYTES = 2 << 20
SLAB_BYTES = 1 << 20

# What a byte counts as in a word: A-Z as a-z, digits, a-z and all bytes of other characters as they are.
CLASSES = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    CLASSES[_b] = _b
CLASSES[0x41:0x5B] = np.arange(0x61, 0x7B)


def winnowed(grams: np.ndarray, width: int) -> np.ndarray:
    """Where a hash is the smallest of some ``width`` neighbours."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    lowest = grams[: len(grams) - width + 1].copy()
    for k in range(1, width):
        np.minimum(lowest, grams[k : len(grams) - width + 1 + k], out=lowest)
    highest = np.zeros(len(grams), np.uint64)
    for k in range(width):
        view = highest[k : k + len(lowest)]
        np.maximum(view, lowest, out=view)
    return np.flatnonzero(highest == grams)


def _joined(low: bytes, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> bytes:
    return b" ".join([low[a:b] for a, b in zip(starts[at : at + n].tolist(), ends[at : at + n].tolist())])


class BenchmarkIndex:
    """Windows of the benchmark items by their text, and the fingerprints that lead to them."""

    def __init__(self, items: list[tuple[int | None, str]], window: int, gram: int) -> None:
        self.window, self.gram, self.width = window, gram, window - gram + 1
        raw, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        starts, ends, hashes, rows = words_of(raw, CLASSES, offsets)
        low = CLASSES[raw].tobytes()
        self.windows: dict[bytes, set] = {}
        kept = []
        short: dict[int, list] = {}
        for r, (item, _) in enumerate(items):
            lo, hi = np.searchsorted(rows, [r, r + 1]).tolist()
            if hi - lo >= window:
                own = chain_hash(hashes[lo:hi], gram)
                kept.append(own[winnowed(own, self.width)])
            elif hi > lo:
                short.setdefault(hi - lo, []).append(chain_hash(hashes[lo:hi], hi - lo))
            for at in range(lo, max(hi - window + 1, lo + (hi > lo))):
                self.windows.setdefault(_joined(low, starts, ends, at, min(window, hi - lo)), set()).add(item)
        self.kept = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        self.short = {n: np.unique(np.concatenate(h)) for n, h in short.items()}

    def hits(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, set]], np.ndarray, np.ndarray]:
        """(row of each word, items by row for rows with any, hit words, first word of each row)."""
        starts, ends, hashes, rows = words_of(raw, CLASSES, offsets)
        first = np.searchsorted(rows, np.arange(len(offsets)))
        low = CLASSES[raw].tobytes()
        hit = np.zeros(len(rows), bool)
        items: dict[int, set] = {}
        grams = chain_hash(hashes, self.gram)
        places = winnowed(grams, self.width)
        places = places[_among(grams[places], self.kept)]
        windows = np.unique((places[:, None] - np.arange(self.width)).ravel())
        todo = [(windows, self.window)]
        for n, own in self.short.items():
            todo.append((np.flatnonzero(_among(chain_hash(hashes, n), own)), n))
        for places, n in todo:
            places = places[(places >= 0) & (places + n <= len(rows))]
            places = places[rows[places] == rows[places + n - 1]]
            for at in places.tolist():
                found = self.windows.get(_joined(low, starts, ends, at, n))
                if found:
                    hit[at : at + n] = True
                    items.setdefault(int(rows[at]), set()).update(found)
        return rows, sorted(items.items()), hit, first

    def search(self, column: pa.Array):
        """(number of the first row, items by row, hit words, first word of each row) of some rows at a time."""
        for lo, texts in slabs(column, SLAB_BYTES):
            yield lo, *self.hits(*text_bytes(texts))[1:]


def _among(values: np.ndarray, kept: np.ndarray) -> np.ndarray:
    if not len(kept):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(kept, values), len(kept) - 1)
    return kept[at] == values


def find_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each document.

    A window is ``window`` neighbouring words of an item, or a shorter item as a whole. Null and empty
    texts have no words. Items without an item_id mark words but are not counted or listed. Repeated
    items count once, repeated documents each have a row; an empty benchmark leaves all clean. Other
    columns are not read.
    """
    spark = documents.sparkSession
    items, slices = _sliced(benchmark, slice_bytes)
    docs = documents.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    passes = [_one_pass(spark, docs, items, k, slices, window, gram) for k in range(slices)]
    if slices == 1:
        return _summary(passes[0])
    merged = passes[0]
    for one in passes[1:]:
        merged = merged.unionByName(one)
    # Rows that agree in doc_id and text come back as often as there were of them.
    return _summary(
        merged.groupBy("doc_id", "h")
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            (F.count("*") / slices).cast("int").alias("copies"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    )


def drop_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The rows of ``documents`` that hold no passage, with all their columns; each by its own text."""
    spark = documents.sparkSession
    items, slices = _sliced(benchmark, slice_bytes)
    # Rows go to Python as a whole and once; the text is read where it lies.
    place = [name.lower() for name in documents.columns].index("text")
    clean = documents.select(F.struct("*").alias("row"))
    schema = T.StructType([T.StructField("row", documents.schema)])
    for k in range(slices):
        index = _shared_index(spark, items, k, slices, window, gram)

        def keep(batches, index=index):
            for batch in batches:
                clear = np.ones(batch.num_rows, bool)
                for lo, found, _, _ in index().search(pc.struct_field(batch.column(0), place)):
                    for row, _ in found:
                        clear[lo + row] = False
                yield batch.filter(pa.array(clear))

        clean = clean.mapInArrow(keep, schema)
    return clean.select("row.*")


def _sliced(benchmark: DataFrame, slice_bytes: int) -> tuple[DataFrame, int]:
    """The distinct items that have a text, and how many slices they make."""
    items = benchmark.selectExpr("CAST(item_id AS bigint) AS item_id", "text").where("text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return items, max(1, -(-total // slice_bytes))


def _summary(found: DataFrame) -> DataFrame:
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def _shared_index(spark, items: DataFrame, k: int, slices: int, window: int, gram: int):
    """A function that gives tasks the index of slice ``k``, built once for each worker."""
    own = items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k) if slices > 1 else items
    # At most about slice_bytes: the total was summed before.
    shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in own.collect()])
    number = shared._jbroadcast.id()

    def index() -> BenchmarkIndex:
        return kept(("benchmark", number), lambda: BenchmarkIndex(shared.value, window, gram))

    return index


def _one_pass(spark, docs: DataFrame, items: DataFrame, k: int, slices: int, window: int, gram: int) -> DataFrame:
    index = _shared_index(spark, items, k, slices, window, gram)

    def work(batch: pa.RecordBatch) -> list:
        counts: list[np.ndarray] = []
        hits: list[list[int]] = [[] for _ in range(batch.num_rows)]
        named: list[list[int]] = [[] for _ in range(batch.num_rows)]
        for lo, found, hit, first in index().search(batch.column(1)):
            counts.append(np.diff(first))
            for row, its in found:
                hits[lo + row] = np.flatnonzero(hit[first[row] : first[row + 1]]).tolist()
                named[lo + row] = [i for i in its if i is not None]
        return [
            batch.column(0),
            batch.column(2),
            pa.array(np.concatenate([*counts, np.zeros(0, np.int64)]), pa.int64()),
            pa.array(hits, pa.list_(pa.int32())),
            pa.array(named, pa.list_(pa.int64())),
        ]

    return map_batches(
        docs.select("doc_id", "text", F.xxhash64("text").alias("h")),
        work,
        "doc_id bigint, h bigint, n_words bigint, hits array<int>, items array<bigint>",
    )
