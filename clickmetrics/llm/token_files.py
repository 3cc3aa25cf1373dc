"""Token ids in binary files with Elias-Fano document boundaries.

A file row is one segment: a run of documents in ascending doc_id order whose ids lie end to end
in one array, with the boundaries between them as an Elias-Fano code: the low bits of each boundary
side by side, the high bits as a unary bit vector. A boundary is found by a select on that vector,
with the positions of every ``SELECT_STEP``-th one kept, so no table of 64-bit offsets is needed:
about 2 + log2(ids / documents) bits a document. Segments are bounded, so a task holds one at a time.

Rows are dealt into doc_id ranges (the one shuffle; Spark's sampled bounds, so sizes are even),
sorted, encoded and written where they lie. Places in the whole corpus come from sums over
segments, of which there is one for some megabytes of ids.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmetrics.llm.common import CACHE_CHARS, CACHE_WORDS, quiet_tokenizers, slabs, tokenizer_path
from clickmetrics.session import work_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SEGMENT_IDS = 1 << 20
SEGMENT_DOCS = 1 << 15
SELECT_STEP = 256
# Text that is encoded at a time.
SLAB_BYTES = 1 << 23
# Words of letters that are kept; others, which may be made of them, are bounded by CACHE_WORDS.
KEPT_LETTERS = 1_000_000
# Signs that the tokenizer takes as one run when they end a word.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
FILE_SCHEMA = "part int, segment int, doc_ids array<bigint>, width int, ids binary, n_ids bigint, low_bits int, low binary, high binary, select binary"


def _composed(word: str) -> bool:
    """Whether lowering a word keeps to one letter each and composing leaves it as it is."""
    return unicodedata.is_normalized("NFC", word) and len(word.lower()) == len(word) and "Σ" not in word


def _lowered(text: str) -> str:
    """The text in lower case, where the tokenizer gives both the same ids; else as it is.

    Special strings are known before letters are lowered, so a text that may hold one stays.
    """
    if "<|" in text or not (text.isascii() or _composed(text)):
        return text
    low = text.lower()
    return low if unicodedata.is_normalized("NFC", low) else text


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``most``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, select: bytes) -> None:
        self.n, self.low_bits, self.low, self.high, self.select = n, low_bits, low, high, select

    @classmethod
    def of(cls, values: np.ndarray, most: int) -> EliasFano:
        values = values.astype(np.int64)
        n = len(values)
        low_bits = max(0, (most // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros((most >> low_bits) + n + 1, np.uint8)
        high[places] = 1
        select = places[::SELECT_STEP].astype("<u4").tobytes()
        return cls(n, low_bits, low, np.packbits(high, bitorder="little").tobytes(), select)

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), np.int64)
        at = k[:, None] * self.low_bits + np.arange(self.low_bits)
        raw = np.frombuffer(self.low, np.uint8)
        return (((raw[at >> 3] >> (at & 7)) & 1).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def __getitem__(self, k: int) -> int:
        """Number ``k``: from the last kept place on, the set bits are counted up to the one asked for."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        place = int(np.frombuffer(self.select, "<u4")[k // SELECT_STEP])
        left, byte = k % SELECT_STEP, place >> 3
        word = self.high[byte] >> (place & 7) << (place & 7)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - k << self.low_bits) + int(self._low(np.array([k]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        k = np.arange(self.n)
        return ((places - k) << self.low_bits) + self._low(k)


class WordEncoder:
    """Ids by the tokenizers library. Its pre-tokenizer drops white space, so words are encoded once and kept.

    Only blanks, tabs and line ends cut words here; the library itself deals with all other space. It
    also cuts letters from punctuation and lowers them, so the letters of plain words are kept apart
    from the signs behind them; new ones go to the library as one text, cut again behind each word-end id.
    """

    def __init__(self, path: str) -> None:
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.stops = {"": b""}

    def _ids(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in coded]

    def _learn(self, letters: list[str]) -> None:
        """Keeps the ids of words that are letters only."""
        for k in range(0, len(letters), 4096):
            some = letters[k : k + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            raw = ids.tobytes()
            self.letters.update((w, raw[a:b]) for w, a, b in zip(some, [0, *ends[:-1]], ends, strict=True))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit words for each text. Words are looked up once for all texts, not once an occurrence."""
        cut = pa.array([_lowered(t).replace("\n", " ").replace("\t", " ").replace("\r", " ") for t in texts], pa.large_string())
        cut = pc.split_pattern(cut, " ")
        coded = cut.flatten().dictionary_encode()
        found = self._found(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.array([len(b) // 4 for b in found], np.int64)
        begin = np.cumsum(size) - size
        word = coded.indices.to_numpy()
        size = size[word]
        end = np.concatenate([[0], np.cumsum(size)])
        out = ids[np.repeat(begin[word] - end[:-1], size) + np.arange(end[-1])]
        bounds = end[cut.offsets.to_numpy()].tolist()
        return [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def _found(self, asked: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        if len(self.letters) > KEPT_LETTERS:
            self.letters = {}
        words = self.words
        new = [w for w in asked if w not in words]
        plain, other = [], []
        for word in new:
            core = word.rstrip(SIGNS)
            if core.isalpha() and len(word) <= CACHE_CHARS and (core.isascii() or _composed(core)):
                plain.append((word, core.lower(), word[len(core) :]))
            else:
                other.append(word)
        if len(self.stops) > CACHE_WORDS:
            self.stops = {"": b""}
        stops = [stop for stop in {stop for *_, stop in plain} if stop not in self.stops]
        self.stops.update(zip(stops, self._ids(stops)))
        self._learn([core for core in {core for _, core, _ in plain} if core not in self.letters])
        words.update((word, self.letters[core] + self.stops[stop]) for word, core, stop in plain)
        fresh = dict(zip(other, self._ids(other)))
        words.update((w, b) for w, b in fresh.items() if len(w) <= CACHE_CHARS)
        long = {w: b for w, b in fresh.items() if len(w) > CACHE_CHARS}
        return [words[w] if w in words else long[w] for w in asked]

    @property
    def id_bound(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    if name not in _encoders:
        _encoders[name] = WordEncoder(name if "/" in name else tokenizer_path(name))
    return _encoders[name]


def _segments(batches: Iterator[pa.RecordBatch], name: str, end_id: int) -> Iterator[pa.RecordBatch]:
    own = encoder(name)
    width = 2 if max(own.id_bound, end_id + 1) <= 1 << 16 else 4
    end = int(end_id).to_bytes(4, "little")
    keys: list[int | None] = []
    blobs: list[bytes] = []
    size = count = 0
    part = None

    def packed() -> pa.RecordBatch:
        lengths = np.array([len(b) // 4 for b in blobs])
        ids = np.frombuffer(b"".join(blobs), "<u4").astype(f"<u{width}").tobytes()
        ends = EliasFano.of(np.cumsum(lengths), int(lengths.sum()))
        columns = [[part], [count], [list(keys)], [width], [ids], [int(lengths.sum())], [ends.low_bits]]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.int64(), pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays += [pa.array([b], pa.binary()) for b in (ends.low, ends.high, ends.select)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FILE_SCHEMA.split(", ")])

    for batch in batches:
        for lo, rows in slabs(batch.column(1), SLAB_BYTES):
            texts = [t or "" for t in rows.cast(pa.large_string()).to_pylist()]
            ids, parts = (batch.column(k).slice(lo, len(rows)).to_pylist() for k in (0, 2))
            for key, its_part, blob in zip(ids, parts, own.encode_batch(texts)):
                if keys and (its_part != part or size + len(blob) // 4 >= SEGMENT_IDS or len(keys) >= SEGMENT_DOCS):
                    yield packed()
                    count = count + 1 if its_part == part else 0
                    keys, blobs, size = [], [], 0
                part = its_part
                keys.append(key)
                blobs.append(blob + end)
                size += len(blob) // 4 + 1
    if keys:
        yield packed()


def write_token_files(df: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Writes ids of every whole ``text`` in ascending ``doc_id`` order to files below ``path``.

    Null texts count as empty, null doc_ids come first, rows with one doc_id stand together, ordered
    by text; other columns are not read. An empty table gives files without segments.
    """
    ranged = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    parts = int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The text's hash lets many rows of one doc_id spread over parts.
    ranged = (
        ranged.withColumn("h", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    ranged.mapInArrow(lambda batches: _segments(batches, tokenizer, end_id), FILE_SCHEMA).write.option(
        "compression", "zstd"
    ).parquet(path)


def _segment_ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a segment, and the place behind each document's last one."""
    bounds = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["select"])
    return np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4"), bounds.all()


def document_ids(row: dict, k: int) -> np.ndarray:
    """Ids of the ``k``-th document of a segment, found by select without reading its neighbours."""
    bounds = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["select"])
    lo = bounds[k - 1] if k else 0
    size = row["width"]
    return np.frombuffer(row["ids"][lo * size : bounds[k] * size], f"<u{size}")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): what the files hold about each document."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row for each part, not for each document: the window over all parts stays small.
    of_parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start")
    )
    in_part = Window.partitionBy("part").orderBy("segment")
    starts = files.select("part", "segment", "n_ids").select(
        "part", "segment", (F.sum("n_ids").over(in_part) - F.col("n_ids")).alias("in_part")
    )
    placed = starts.join(of_parts, "part").select(
        "part", "segment", (F.col("in_part") + F.col("part_start")).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                ids, ends = _segment_ids(row)
                begins = np.concatenate([[0], ends[:-1]])
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(crc), pa.int32()),
                        pa.array([row["segment"]] * len(crc), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins, pa.int64()),
                        pa.array(ends - begins, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "segment", "doc_id", "begin", "n_tokens", "ids_crc32"],
                )

    schema = "part int, segment int, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"
    return (
        files.mapInArrow(run, schema)
        .join(placed, ["part", "segment"])
        .select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
    )


def through_files(df: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Writes the files into the shared folder and reads them back: (doc_id, start, n_tokens, ids_crc32)."""
    spark = df.sparkSession
    path = work_folder(spark, "token-files")
    write_token_files(df, path, tokenizer, end_id)
    return read_token_files(spark, path)
