"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut a text's bytes without a gap, so two tokens overlap exactly if the start of one
lies inside the other. ``pandas.merge_asof``, keyed by document, finds for each token start the
covering token of the other side; the union of both directions is all overlaps ("links"). Byte
offsets at which tokens of both sides end cut a document into groups.

What a link is worth depends on the corpus: how often its id pair is linked anywhere, and whether
that is the most for its id of the second tokenizer. Documents are aligned in blocks of some
megabytes. A block is written once, with the id pairs of its documents and how often each stands in
the block. Counts are summed over blocks (one row for each pair and block, not for each link), and
each block gets the counts of its own pairs back.

Memory follows a block, or the longest text. Very frequent pairs are summed inside blocks and tasks
first; the join that leads counts back has one row for each block and pair, and adaptive execution
may split it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import keep_files, quiet_tokenizers, tokenizer_path

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
# Bytes of text that are aligned at once, and that share a block.
SLICE = 1 << 21
BLOCK = 1 << 24
SLICE_DOCS = 1 << 14
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, sha array<string>, sizes array<int>, places binary, times binary, "
    "codes array<bigint>, sums array<bigint>"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the rest as letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """Encodes texts, and knows the bytes of each id."""

    def __init__(self, entries: list[bytes]) -> None:
        self.size = len(entries)
        self.entries = np.array([*entries, None], object)[:-1]
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.lengths[self.lengths == 0] = 1 << 40  # an id without bytes never fits a text
        # Each id as text, before the four things that may follow it.
        self.names = np.array([f"{k}{mark}" for mark in (",", "|", ";", "") for k in range(self.size)], object)

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError


class ByteSide(Side):
    """A byte-level BPE file of the tokenizers library; special strings in texts are plain text."""

    def __init__(self, path: str) -> None:
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = _byte_of_letter()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocabulary.values()) + 1)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        for token, k in vocabulary.items():
            entries[k] = b"" if token in special else bytes(byte_of[c] for c in token)
        super().__init__(entries)
        self.fast = self._fast(path, vocabulary, special)

    def _fast(self, path: str, vocabulary: dict[str, int], special: set[str]):
        """The same merges as ranks in a faster library, if ids rise in the order of the merges."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        ids = [vocabulary["".join(m)] for m in merges]
        kind = read["pre_tokenizer"] or {}
        plain = kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and read["normalizer"] is None
        if not plain or any(b <= a for a, b in zip(ids, ids[1:])):
            return None
        ranks = {bytes(self.entries[k]): k for t, k in vocabulary.items() if t not in special}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            try:
                return [self.fast.encode_ordinary(t) for t in texts]
            except BaseException as error:  # its pattern engine gives up on some very long texts
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide(Side):
    """A SentencePiece model; it adds the first space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            byte = model.is_byte(k)
            entries.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode())
        super().__init__(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


_sides: dict[str, Side] = {}


def side(name: str) -> Side:
    """The tokenizer of a file, loaded once in a worker."""
    if name not in _sides:
        path = name if "/" in name else tokenizer_path(name)
        _sides[name] = PieceSide(path) if path.endswith(".model") else ByteSide(path)
    return _sides[name]


class Aligned:
    """Tokens, links and groups of some documents.

    ``a`` and ``b`` are ids end to end, ``a_of`` and ``b_of`` the documents that hold them. A document
    has no tokens where its text is empty or either side does not give back its bytes.
    """

    def __init__(self, texts: list[str], first: Side, second: Side) -> None:
        self.first, self.second = first, second
        spaced = [" " + t for t in texts]
        wanted = [t.encode("utf-8", "surrogatepass") if text else b"" for text, t in zip(texts, spaced)]
        self.a, a_sizes = self._ids(first, spaced, wanted)
        self.b, b_sizes = self._ids(second, spaced, wanted)
        good = (a_sizes > 0) & (b_sizes > 0)
        self.a, self.b = self.a[np.repeat(good, a_sizes)], self.b[np.repeat(good, b_sizes)]
        self.n_a, self.n_b = a_sizes * good, b_sizes * good
        docs = np.arange(len(texts))
        self.a_of, self.b_of = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        self.a_end, self.b_end = np.cumsum(first.lengths[self.a]), np.cumsum(second.lengths[self.b])
        self._link()
        self._group()

    @staticmethod
    def _ids(own: Side, texts: list[str], wanted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and their number by document; documents whose bytes differ have none."""
        coded = own.encode(texts)
        sizes = np.array([len(c) for c in coded], np.int64)
        ids = np.array([k for c in coded for k in c], np.int64)
        joined = b"".join(own.entries[ids].tolist())
        if joined == b"".join(wanted):
            ends = np.concatenate([[0], np.cumsum(own.lengths[ids])])[np.cumsum(sizes)]
            if np.array_equal(ends, np.cumsum([len(w) for w in wanted])):
                return ids, sizes
        kept, begin = [], 0
        for k, size in enumerate(sizes.tolist()):
            part = ids[begin : begin + size]
            begin += size
            if wanted[k] and b"".join(own.entries[part].tolist()) == wanted[k]:
                kept.append(part)
            else:
                sizes[k] = 0
        return np.concatenate(kept) if kept else np.zeros(0, np.int64), sizes

    def _link(self) -> None:
        """All pairs of an A and a B token (places in ``a`` and ``b``) whose byte ranges overlap."""
        a_start, b_start = self.a_end - self.first.lengths[self.a], self.b_end - self.second.lengths[self.b]
        a = pd.DataFrame({"at": a_start, "doc": self.a_of, "a": np.arange(len(self.a)), "a_at": a_start})
        b = pd.DataFrame({"at": b_start, "doc": self.b_of, "b": np.arange(len(self.b)), "b_at": b_start})
        of_a = pd.merge_asof(a[["at", "doc", "a"]], b, on="at", by="doc")
        of_b = pd.merge_asof(b[["at", "doc", "b"]], a, on="at", by="doc")
        of_b = of_b[of_b["a_at"] < of_b["at"]]  # equal starts came from the other direction
        self.link_a = np.concatenate([of_a["a"], of_b["a"]]).astype(np.int64)
        self.link_b = np.concatenate([of_a["b"], of_b["b"]]).astype(np.int64)
        self.link_of = np.concatenate([of_a["doc"], of_b["doc"]]).astype(np.int64)

    def _group(self) -> None:
        """The group of each token: ends common to both sides before it."""
        common = np.intersect1d(self.a_end, self.b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(common, self.a_end), np.searchsorted(common, self.b_end)
        of_group = np.zeros(len(common), np.int64)
        of_group[self.a_group] = self.a_of
        self.n_groups = np.bincount(of_group, minlength=len(self.n_a))

    def group_texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document."""
        names = []
        for ids, group, own, between in ((self.a, self.a_group, self.first, 1), (self.b, self.b_group, self.second, 2)):
            last = np.ones(len(ids), bool)
            last[:-1] = group[1:] != group[:-1]
            names.append(own.names[ids + own.size * np.where(last, between, 0)])
        # A group's A tokens, then its B tokens.
        whole = np.concatenate(names)
        order = np.argsort(np.concatenate([2 * self.a_group, 2 * self.b_group + 1]), kind="stable")
        whole = whole[order].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(whole[a:b])[:-1] for a, b in zip([0, *ends], ends)]


def _planes(values: np.ndarray) -> bytes:
    """32-bit words, packed: all lowest bytes first, so that small values leave long runs of zeros."""
    raw = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _from_planes(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Rows (doc_id, text) with some megabytes of text at a time."""
    keys, texts = [], []
    size = 0
    for lo in range(0, batch.num_rows, 64):
        some = batch.slice(lo, 64)
        for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
            text = text or ""
            if keys and (size + len(text) > SLICE or len(keys) >= SLICE_DOCS):
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += len(text)
    if keys:
        yield keys, texts


class _Block:
    """Gathers aligned documents until they are written as one row."""

    def __init__(self) -> None:
        self.columns: dict[str, list] = {name: [] for name in ("doc_ids", *COUNTS, "sha")}
        self.sizes: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, keys: list, texts: list[str], first: Side, second: Side) -> None:
        one = Aligned(texts, first, second)
        own = self.columns
        own["doc_ids"] += keys
        n_links = np.bincount(one.link_of, minlength=len(keys))
        for name, values in zip(COUNTS, (one.n_a, one.n_b, one.n_groups, n_links)):
            own[name] += values.tolist()
        own["sha"] += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in one.group_texts()]
        pairs = first.size * second.size
        code = one.a[one.link_a] * second.size + one.b[one.link_b]
        both, times = np.unique(one.link_of * pairs + code, return_counts=True)
        self.codes.append(both % pairs)
        self.times.append(times)
        self.sizes.append(np.bincount(both // pairs, minlength=len(keys)))
        self.bytes += sum(map(len, texts))

    def row(self, number: int) -> pa.RecordBatch:
        sizes, codes, times = map(np.concatenate, (self.sizes, self.codes, self.times))
        distinct, places = np.unique(codes, return_inverse=True)
        sums = np.bincount(places, times, len(distinct)).astype(np.int64)
        # Places rise inside a document: kept as steps, modulo 2**32 where a document begins.
        steps = np.diff(places, prepend=0) % (1 << 32)
        values = [number, *(self.columns[n] for n in ("doc_ids", *COUNTS, "sha")), sizes.tolist()]
        values += [_planes(steps), _planes(times), distinct, sums]
        names = [part.split()[0] for part in BLOCKS.split(", ")]
        long = pa.list_(pa.int64())
        kinds = [pa.int64(), *[long] * 5, pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.binary()] * 2, long, long]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _blocks(batches: Iterator[pa.RecordBatch], first: str, second: str) -> Iterator[pa.RecordBatch]:
    a, b = side(first), side(second)
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    block = _Block()
    for batch in batches:
        for keys, texts in _slices(batch):
            block.add(keys, texts, a, b)
            if block.bytes >= BLOCK:
                yield block.row(number)
                number += 1
                block = _Block()
    if block.sizes:
        yield block.row(number)


def _scored(block: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block, given (pos, value) for its id pairs: twice the count, plus 1 for a best one."""
    out = []
    for k in range(block.num_rows):
        row = {n: block.column(n)[k].as_py() for n in ("doc_ids", *COUNTS, "sha", "sizes", "places", "times")}
        value = np.zeros(counts.num_rows, np.int64)
        value[counts.column("pos").to_numpy()] = counts.column("value").to_numpy()
        sizes = np.array(row["sizes"], np.int64)
        places = np.cumsum(_from_planes(row["places"])) % (1 << 32)
        times = _from_planes(row["times"])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        totals = [np.concatenate([[0], np.cumsum(v)]) for v in (times * (value[places] & 1), times * (value[places] >> 1))]
        best, total = (t[bounds[1:]] - t[bounds[:-1]] for t in totals)
        columns = [row["doc_ids"], *(row[n] for n in COUNTS), best, total, row["sha"]]
        kinds = [pa.int64()] * 7 + [pa.string()]
        names = [part.split()[0] for part in RESULT.split(", ")]
        out.append(pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names))
    return pa.concat_tables(out) if out else pa.table({p.split()[0]: [] for p in RESULT.split(", ")})


def pair_counts(blocks: DataFrame, second: str = SECOND) -> DataFrame:
    """(code, value): how often each id pair is linked, twice, plus 1 if no pair of its B id is linked more often."""
    size = side(second).size
    spread = blocks.select(F.explode(F.arrays_zip("codes", "sums")).alias("p"))
    counted = spread.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.sums").alias("n"))
    counted = keep_files(blocks.sparkSession, counted, "pair-counts")
    highest = counted.groupBy((F.col("code") % size).alias("b")).agg(F.max("n").alias("most"))
    return counted.join(highest, F.col("code") % size == F.col("b")).select(
        "code", (2 * F.col("n") + (F.col("n") == F.col("most")).cast("bigint")).alias("value")
    )


def align_documents(df: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of ``df``.

    Null and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens:
    zeros and an empty digest. Null and repeated doc_ids stay, each row for itself; doc_id is read as
    a long; other columns are not read. An empty table gives none.
    """
    rows = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    blocks = rows.mapInArrow(lambda batches: _blocks(batches, first, second), BLOCKS)
    blocks = keep_files(df.sparkSession, blocks, "aligned-blocks")
    asked = blocks.select(F.col("block").alias("owner"), F.posexplode("codes").alias("pos", "code"))
    told = asked.join(pair_counts(blocks, second), "code").select("owner", "pos", "value")
    plain = blocks.drop("codes", "sums")
    return plain.groupBy("block").cogroup(told.groupBy("owner")).applyInArrow(_scored, RESULT)


def token_groups(df: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """(doc_id, a, b, groups): ids of both sides and the groups of each whole text, written ``a1,a2|b1;a3|b2,b3``.

    Odd rows are treated as by ``align_documents``; without tokens the lists and the groups are empty.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in _slices(batch):
                one = Aligned(texts, side(first), side(second))
                columns = [pa.array(keys, pa.int64())]
                for ids, sizes in ((one.a, one.n_a), (one.b, one.n_b)):
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))))
                columns.append(pa.array(one.group_texts(), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a", "b", "groups"])

    rows = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(work, "doc_id bigint, a array<int>, b array<int>, groups string")
