"""Exact n-gram Jaccard join with prefix, length, positional and suffix filters.

A document is the set of its distinct word n-grams, as 64-bit hashes. Sets that are equal (by a 128-bit
digest) become one class, a node with a number of its own, so copies never meet. The n-grams of a set are
put in one global order, rare ones first: the document frequency of every n-gram is counted over all
documents into a table of hash cells, whose size is fixed whatever the corpus (cells that clash only blur
the order, never the result). Sets that are similar enough share an n-gram of their prefixes, which are
short by that order.

Classes meet in the groups of one prefix n-gram. A pair is a candidate if it passes the positional filter,
which covers the length filter, and the parity sketches of the two sets, whose bits cannot differ more than
the sets do. The sketches travel with the prefix n-grams, so members without any candidate in their group
leave at once, and what goes on is as large as the near copies are. Groups over ``PRUNE`` members keep all.

Round 1 verifies one pair for each node, with the smallest node it has as a candidate; round 2 up to
``NEAREST`` pairs a node, with the nearest by longer sketches among other components; the last round all
candidates of different components, in blocks of ``BLOCK`` members, dealt over tasks by pairs of blocks.
Every pair is verified once, with the suffix filter before the full intersection. No link between
components is lost: whatever shares a prefix n-gram is joined already, tested, or ruled out by a filter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import chain_hash, forget, keep_files, map_batches, mix64, text_bytes, words_of
from clickmetrics.llm.components import components

# A document's words are runs of anything but blanks; A-Z count as a-z. Values are bytes plus one.
CLASSES = np.arange(1, 257, dtype=np.uint16)
CLASSES[0x41:0x5B] += 0x20
CLASSES[[0x20, *range(0x09, 0x0E)]] = 0

CELL_BITS = 20
SLICES = 64
GROUP_MEMBERS = 512
# Bits of the sketch that travels with a prefix n-gram, by the size of the set; those of later rounds are LONGER.
SKETCH = (128, 512)
LONGER = 4
PRUNE = 512
NEIGHBOURS = 48
NEAREST = 4
BLOCK = 1024
# Rows of one task that are worked at a time; members of a longer group are all kept for the last round.
SLAB = 1 << 16


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a shorter text is one n-gram, an empty one none."""
    raw, offsets = text_bytes(column)
    step = 256
    for lo in range(0, len(column), step):
        own = offsets[lo : min(lo + step, len(column)) + 1]
        _, _, hashes, rows = words_of(raw[own[0] : own[-1]], CLASSES, own - own[0])
        grams = chain_hash(hashes, n)
        first = np.searchsorted(rows, np.arange(len(own))).tolist()
        for a, b in zip(first, first[1:]):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            else:
                yield chain_hash(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def gram_frequencies(df: DataFrame, n: int) -> np.ndarray:
    """How many documents hold an n-gram of each cell, over all rows of ``df``; 2**CELL_BITS numbers."""
    size = (1 << CELL_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        cells = np.zeros(1 << CELL_BITS, np.int64)
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            for grams in shingle_sets(batch.column(0), n):
                held.append(grams)
                waiting += len(grams)
                if waiting > 1 << 20:
                    cells += np.bincount(_cell(np.concatenate(held)), minlength=1 << CELL_BITS)
                    held, waiting = [], 0
        if held:
            cells += np.bincount(_cell(np.concatenate(held)), minlength=1 << CELL_BITS)
        blobs = [zlib.compress(c.astype("<i8").tobytes(), 1) for c in cells.reshape(SLICES, size)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "cells"]
        )

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in parts:
            for blob in part.column("cells"):
                total += np.frombuffer(zlib.decompress(blob.as_py()), "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            names=["slice", "cells"],
        )

    summed = df.select("text").mapInArrow(count, "slice int, cells binary").groupBy("slice").applyInArrow(
        add, "slice int, cells binary"
    )
    out = np.zeros((SLICES, size), np.int64)
    for row in summed.collect():  # SLICES rows of a fixed size
        out[row["slice"]] = np.frombuffer(row["cells"], "<i8")
    return out.ravel()


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """An upper bound of the intersection: both sets are cut at one value, again and again."""
    if depth == 0 or len(a) < 8 or len(b) < 8:
        return min(len(a), len(b))
    middle = b[len(b) // 2]
    i, j = int(np.searchsorted(a, middle)), len(b) // 2
    return _suffix_bound(a[:i], b[:j], depth - 1) + _suffix_bound(a[i:], b[j:], depth - 1)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    if min(len(a), len(b)) < need or _suffix_bound(a, b) < need:
        return False
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum()) >= need


def _by_token(members: DataFrame, work, schema: str, slab: int = SLAB, whole: bool = False) -> DataFrame:
    """Runs ``work(torn, token, *columns)`` over groups of one token; rows come sorted by node.

    Several groups are worked at once, about ``slab`` rows. A group of more rows comes in pieces, and ``torn`` holds its
    token, unless groups shall be ``whole``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        torn: set[int] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < slab:
                continue
            first, last = held[0].column(0)[0].as_py(), batch.column(0)[-1].as_py()
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.searchsorted(table.column(0).to_numpy(), last))
            if first == last:
                if whole:
                    continue  # one group still
                torn.add(last)
                cut = rows
            yield from work(torn, *[c.to_numpy() for c in table.slice(0, cut).columns])
            torn &= {last}
            held = table.slice(cut).to_batches() if cut < rows else []
            rows -= cut
        if rows:
            yield from work(torn, *[c.to_numpy() for c in pa.Table.from_batches(held).combine_chunks().columns])

    ordered = members.repartition("token").sortWithinPartitions("token", "node")
    return ordered.mapInArrow(run, schema)


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _groups(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    return starts, np.concatenate([starts[1:], [len(token)]])


def sketch_size(n: int, percent: int) -> int:
    """Bits of the sketch of a set of n: unlike sets differ in half of them, similar ones in fewer."""
    apart = 2 * n * (100 - percent) // (100 + percent)
    size = SKETCH[0]
    while size < SKETCH[1] and size / 2 - 2 * size**0.5 <= apart:
        size *= 2
    return size


def parity_bits(grams: np.ndarray, size: int) -> bytes:
    """``size`` bits of a set; sets differ in at least as many n-grams as their bits differ."""
    odd = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes, times: int) -> bytes:
    """The sketch of the same set with ``times`` fewer bits."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(times, -1), axis=0).tobytes()


class Sketches:
    """Parity sketches of several sizes; of two sizes the longer is folded to the shorter."""

    def __init__(self, blobs: np.ndarray):
        self.words = np.fromiter((len(b) // 8 for b in blobs), np.int64, len(blobs))
        self.levels = {}
        size = int(self.words.max())
        held, table = np.zeros(0, np.int64), np.zeros((0, size), np.uint64)
        while size >= int(self.words.min()):
            own = np.flatnonzero(self.words == size)
            exact = np.frombuffer(b"".join(blobs[own]), "<u8").reshape(len(own), size)
            held, table = np.concatenate([held, own]), np.concatenate([table, exact])
            place = np.zeros(len(blobs), np.int64)
            place[held] = np.arange(len(held))
            self.levels[size] = place, table
            table = table[:, : size // 2] ^ table[:, size // 2 :]
            size //= 2

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        level = np.minimum(self.words[i], self.words[j])
        out = np.zeros(len(level), np.int64)
        for size, (place, table) in self.levels.items():
            at = np.flatnonzero(level == size)
            if len(at):
                out[at] = np.bitwise_count(table[place[i[at]]] ^ table[place[j[at]]]).sum(axis=1, dtype=np.int64)
        return out


def _candidates(i, j, n, pos, sketches: Sketches, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the pairs that may link, and in how many bits they differ."""
    need = least_overlap(n[i], n[j], percent)
    # If this is the first n-gram they share, no more than what follows it is shared; if it is
    # not, the pair came up at the first one, with more behind it. Covers the length filter.
    yes = np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need
    i, j, need = i[yes], j[yes], need[yes]
    differ = sketches.differ(i, j)
    yes = n[i] + n[j] - differ >= 2 * need
    return i[yes], j[yes], differ[yes]


def _tries(starts: np.ndarray, ends: np.ndarray, width) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j inside the groups: all of groups of up to 32, else of each i the ``width(size)`` members behind it."""
    sizes = ends - starts
    for g in np.unique(sizes[(sizes > 1) & (sizes <= 32)]).tolist():
        a, b = np.triu_indices(g, 1)
        base = starts[sizes == g]
        step = max(1, (1 << 19) // len(a))
        for k in range(0, len(base), step):
            yield (base[k : k + step, None] + a).ravel(), (base[k : k + step, None] + b).ravel()
    for a, b in zip(starts[sizes > 32].tolist(), ends[sizes > 32].tolist()):
        reach = width(b - a)
        for i in range(a, b - 1):
            j = np.arange(i + 1, min(b, i + 1 + reach))
            yield np.full(len(j), i), j


def _first(percent: int):
    """Members that have a candidate in their group, and the smallest smaller node that is one (itself without)."""

    def work(torn, token, node, n, pos, bits) -> Iterator[pa.RecordBatch]:
        starts, ends = _groups(token)
        whole = np.isin(token[starts], list(torn), invert=True) if torn else np.ones(len(starts), bool)
        met = np.repeat((ends - starts > 1) | ~whole, ends - starts)
        token, node, n, pos, bits = token[met], node[met], n[met].astype(np.int64), pos[met].astype(np.int64), bits[met]
        if not len(token):
            return
        starts, ends = _groups(token)
        pruned = ends - starts <= PRUNE
        if torn:
            pruned &= np.isin(token[starts], list(torn), invert=True)
        sketches = Sketches(bits)
        kept = np.repeat(~pruned, ends - starts)
        pivot = np.arange(len(token))

        def note(i: np.ndarray, j: np.ndarray) -> None:
            kept[i] = kept[j] = True
            fresh = pivot[j] == j
            i, j = i[fresh], j[fresh]
            pivot[j[::-1]] = i[::-1]  # pairs come with i rising, so the smallest is written last

        for i, j in _tries(starts[pruned], ends[pruned], lambda size: size):
            note(*_candidates(i, j, n, pos, sketches, percent)[:2])
        for a, b in zip(starts[~pruned].tolist(), ends[~pruned].tolist()):
            for i in range(a, min(b - 1, a + NEIGHBOURS)):
                j = np.arange(i + 1, b)
                j = j[pivot[j] == j]
                note(*_candidates(np.full(len(j), i), j, n, pos, sketches, percent)[:2])
        yield _batch("token node n pos pivot", token[kept], node[kept], n[kept].astype(np.int32), pos[kept].astype(np.int32), node[pivot][kept])

    return work


def _pairs(percent: int, near: bool):
    """Candidates (a, b, differ), a > b, of different components; near ones: of large groups only neighbours in node order."""

    def work(torn, token, node, n, pos, comp, side, bits) -> Iterator[pa.RecordBatch]:
        starts, ends = _groups(token)
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        sketches = Sketches(bits)
        # A group of two blocks only pairs one with the other.
        across = np.repeat(np.minimum.reduceat(side, starts) != np.maximum.reduceat(side, starts), ends - starts)
        out: list[tuple] = []
        held = 0
        for i, j in _tries(starts, ends, lambda size: NEIGHBOURS if near else size):
            open_ = (comp[i] != comp[j]) & ~(across[i] & (side[i] == side[j]))
            i, j, differ = _candidates(i[open_], j[open_], n, pos, sketches, percent)
            if len(i):
                out.append((node[j], node[i], differ))
                held += len(i)
            if held > 1 << 18:
                yield _batch("a b differ", *[np.concatenate(c) for c in zip(*out)])
                out, held = [], 0
        if out:
            yield _batch("a b differ", *[np.concatenate(c) for c in zip(*out)])

    return work


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that link. ``pairs`` (a, b) is distinct; texts go to b, cut into small groups."""
    spark = pairs.sparkSession
    # A pivot with many members is tested in several groups, each with its own copy of the pivot.
    cut = pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(1 << 16)))
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP_MEMBERS).cast("int").alias("parts"))
    cut = cut.join(many, "b").select("a", "b", F.pmod("part", "parts").cast("int").alias("part"), "parts")
    to = cut.select(F.col("a").alias("node"), "b", "part").unionByName(
        many.select(F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )
    sent = (
        to.groupBy("node").agg(F.collect_list(F.struct("b", "part")).alias("to"))
        .join(texts, "node")
        .select("node", "text", F.explode("to").alias("to"))
        .select("node", "text", "to.b", "to.part")
    )

    def test(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = key[0].as_py()
        sets: dict[int, np.ndarray] = {}
        own = None
        for part in parts:
            for node, grams in zip(part.column("node").to_pylist(), shingle_sets(part.column("text"), n)):
                if node == pivot:
                    own = grams
                elif own is not None:
                    sets[node] = grams if _linked(own, grams, percent) else None
                else:
                    sets[node] = grams
        linked = [node for node, grams in sets.items() if grams is not None and _linked(own, grams, percent)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(linked, pa.int64()), pa.array([pivot] * len(linked), pa.int64())], names=["a", "b"]
        )

    return keep_files(spark, sent.groupBy("b", "part").applyInArrow(test, "a bigint, b bigint"), "links")


def link_documents(df: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``df``.

    Documents link when 100 * intersection >= percent * union of their distinct word n-grams;
    component_id is the smallest doc_id reachable by links. A text of fewer words is one n-gram as a
    whole; null and empty texts are linked with nothing and are their own component. Rows with a null
    doc_id keep their links and get the component of the others, or null if there are none with an id.
    """
    return link_rows(df, n, percent).select("doc_id", "n_shingles", "component_id")


def link_rows(df: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """As link_documents, with text_key (xxhash64 of the text) and the number of the row's component.

    Components without any doc_id differ in ``component`` too; null for rows that are linked with nothing
    as they have no words.
    """
    spark = df.sparkSession
    docs = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    frequency = spark.sparkContext.broadcast(gram_frequencies(docs, n))

    def describe(batch: pa.RecordBatch) -> list:
        sizes, keys, prefixes, bits = [], [], [], []
        for grams in shingle_sets(batch.column(1), n):
            sizes.append(len(grams))
            keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            cells = frequency.value[_cell(grams)]
            length = _prefix_length(len(grams), percent) if len(grams) else 0
            bits.append(parity_bits(grams, LONGER * sketch_size(len(grams), percent)))
            prefixes.append(grams[np.lexsort((grams, cells))[:length]].astype(np.int64).tobytes())
        blobs = [pa.array(c, pa.binary()) for c in (keys, prefixes, bits)]
        return [batch.column(0), batch.column(2), pa.array(sizes, pa.int32()), *blobs]

    described = map_batches(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
        describe,
        "doc_id bigint, text_key bigint, n int, key binary, prefix binary, bits binary",
    )
    described = keep_files(spark, described, "sets")
    classes = (
        described.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("one"),
            F.min("doc_id").alias("least"),
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("bits").alias("bits"),
        )
        # Numbers are fixed by the file they are written to.
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = keep_files(spark, classes, "classes")
    nodes = classes.select("node", F.col("one.doc_id").alias("doc_key"), F.col("one.text_key").alias("text_key"))

    def spread(batch: pa.RecordBatch) -> list:
        tokens = [np.frombuffer(b, np.int64) for b in batch.column(2).to_pylist()]
        counts = np.array([len(t) for t in tokens], np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        bits = pa.array([folded(b, LONGER) for b in batch.column(3).to_pylist()], pa.binary())
        return [
            pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])),
            batch.column(0).take(pa.array(row)),
            batch.column(1).take(pa.array(row)),
            pa.array((np.arange(len(row)) - (np.cumsum(counts) - counts)[row]).astype(np.int32)),
            bits.take(pa.array(row)),
        ]

    index = map_batches(
        classes.select("node", "n", "prefix", "bits"), spread, "token bigint, node bigint, n int, pos int, bits binary"
    )
    members = keep_files(
        spark, _by_token(index, _first(percent), "token bigint, node bigint, n int, pos int, pivot bigint"), "members"
    )
    # Texts of one document for each class that met another: the only ones that are compared.
    met = nodes.join(members.select("node").distinct(), "node")
    texts = docs.select("doc_id", "text").withColumn("key_of_text", F.xxhash64("text"))
    texts = texts.join(met, texts.doc_id.eqNullSafe(met.doc_key) & (texts.key_of_text == met.text_key))
    texts = keep_files(spark, texts.select("node", "text"), "texts")

    first = members.where("node <> pivot").groupBy(F.col("node").alias("a")).agg(F.min("pivot").alias("b"))
    tested = keep_files(spark, first, "tested")
    labels = components(_verified(tested, texts, n, percent))
    for near in (True, False):
        placed = members.join(labels, "node", "left").select(
            "token", "node", "n", "pos", F.coalesce("label", "node").alias("comp")
        )
        # Groups whose members are all in one component are done.
        mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
        blocks = F.lit(1) if near else F.ceil(F.col("size") / BLOCK).cast("int")
        mixed = mixed.where("lo <> hi").select("token", blocks.alias("blocks"))
        placed = _in_blocks(placed.join(mixed, "token")).join(classes.select("node", "bits"), "node")
        placed = placed.select("token", "node", "n", "pos", "comp", "side", "bits")
        pairs = _by_token(placed, _pairs(percent, near), "a bigint, b bigint, differ bigint", whole=not near)
        known = tested.union(tested.select("b", "a")).toDF("a", "b")
        pairs = pairs.distinct().join(known, ["a", "b"], "left_anti")
        if near:
            nearest = F.slice(F.sort_array(F.collect_set(F.struct("differ", "b"))), 1, NEAREST)
            pairs = pairs.groupBy("a").agg(nearest.alias("to")).select("a", F.inline("to")).drop("differ")
        pairs = keep_files(spark, pairs.select("a", "b"), "tested")
        if pairs.limit(1).count():
            labels = components(_contracted(_verified(pairs, texts, n, percent), labels))
            tested = tested.unionByName(pairs)
    own = classes.join(labels, "node", "left").select("key", "least", F.coalesce("label", "node").alias("label"))
    lowest = own.groupBy("label").agg(F.min("least").alias("component_id"))
    placed = own.join(lowest, "label").select("key", "label", "component_id")
    return described.join(placed, "key", "left").select(
        "doc_id",
        "text_key",
        F.col("label").alias("component"),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _contracted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """What links new between components, once for each two of them, and each node's place in its own."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), "label")
        links = links.join(own, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    old = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return links.select("a", "b").where("a <> b").distinct().unionByName(old)


def _in_blocks(placed: DataFrame) -> DataFrame:
    """Members of groups of several ``blocks``, once for each pair of blocks that theirs is in, under a token of that pair."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    lone = placed.where("blocks = 1").withColumn("side", F.lit(0)).drop("blocks")
    many = placed.where("blocks > 1").withColumn("side", block)
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("token", F.least("side", "other"), F.greatest("side", "other"))
    return lone.unionByName(many.withColumn("token", pair).drop("blocks", "other"))
