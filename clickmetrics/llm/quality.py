"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A document has three views: its words, the shapes of its words (letter case, digits and signs without
the letters), and how its words repeat the ones just before. Each view is a row of hashed term
weights, tf times idf, of unit length; idf comes from counts over all documents. A truncated singular
value decomposition of the labelled rows gives the latent space. The labelled vectors and the
projection are broadcast; every document is projected and compared with all labelled vectors by exact
cosine, block by block, and the ``NEIGHBOURS`` most similar vote with their labels, weighted by a
power of their similarity.

What is broadcast is bounded by parameters: at most 2 * ``SAMPLE`` vectors of ``LATENT`` numbers and one
projection row for each term place. Fitting takes at most ``SAMPLE`` labelled documents for each label,
by a hash of doc_id; everything else covers all rows. Rows are independent, so scoring needs no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import CACHE_CHARS, CACHE_WORDS, keep_files

SAMPLE = 2000
FOLDS, HELD_OUT = 3, 1
LATENT = 48
NEIGHBOURS = 15
SHARPNESS = 8
POWER_STEPS = 8
SPARE = 16
WORD_PLACES = 1 << 12
SHAPE_PLACES = 1 << 10
REPEATS = 3
PLACES = WORD_PLACES + SHAPE_PLACES + REPEATS
# Characters of text whose features are worked out at once.
SLICE = 1 << 20
# Documents compared with all labelled vectors at once.
ROWS = 512

EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_UPPER = regex.compile(r"\p{Lu}+")
_LETTERS = regex.compile(r"[\p{L}\p{M}--[A]]+", regex.V1)
_DIGITS = regex.compile(r"\p{N}+")
_RUNS = regex.compile(r"(.)\1+", regex.DOTALL)


def shape(word: str) -> str:
    """``A`` for capitals, ``a`` for other letters, ``0`` for digits; two of any sign that stands twice or more."""
    return _RUNS.sub(r"\1\1", _DIGITS.sub("0", _LETTERS.sub("a", _UPPER.sub("A", word))))


class _Codes(dict):
    """Word to a number: a hash of its letters, then the place of its shape. Bounded, closed to long words."""

    def __missing__(self, word: str) -> int:
        plain = word.strip(EDGE).lower() or word
        code = zlib.crc32(plain.encode("utf-8", "replace")) * SHAPE_PLACES
        code += zlib.crc32(shape(word).encode("utf-8", "replace")) % SHAPE_PLACES
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = code
        return code


_codes = _Codes()


def term_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, count) of all terms, by document and place."""
    cut = [t.split() for t in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    codes = np.array([k for c in cut for k in map(_codes.__getitem__, c)], np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    words = codes // SHAPE_PLACES
    repeats = np.zeros(len(codes), np.int64)
    for back in (2, 1):
        same = (words[back:] == words[:-back]) & (of[back:] == of[:-back])
        repeats[back:][same] = back
    places = (words % WORD_PLACES, WORD_PLACES + codes % SHAPE_PLACES, WORD_PLACES + SHAPE_PLACES + repeats)
    keys, counts = np.unique(np.concatenate([of * PLACES + p for p in places]), return_counts=True)
    return keys // PLACES, keys % PLACES, counts


def weights(of: np.ndarray, place: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf times idf; the three views of a document have the same length, together 1."""
    weight = np.where(place < WORD_PLACES, np.log1p(count), count) * idf[place]
    view = np.searchsorted([WORD_PLACES, WORD_PLACES + SHAPE_PLACES], place, side="right")
    lengths = np.sqrt(np.bincount(of * 3 + view, weight * weight))
    return weight / (lengths[of * 3 + view] * 3**0.5)


class Model:
    """The projection of term weights and the labelled vectors."""

    def __init__(self, idf: np.ndarray, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray) -> None:
        self.idf = idf
        self.projection = projection.astype(np.float32)
        self.vectors = vectors.astype(np.float32)
        self.labels = labels.astype(np.float64)

    def latent(self, texts: list[str]) -> np.ndarray:
        """A vector of unit length for each text; zeros for a text without words."""
        of, place, count = term_counts(texts)
        weight = weights(of, place, count, self.idf).astype(np.float32)
        out = np.zeros((len(texts), self.projection.shape[1]), np.float32)
        begins = np.flatnonzero(np.diff(of, prepend=-1))
        for k in range(0, len(begins), 64):
            lo, hi = begins[k], begins[k + 64] if k + 64 < len(begins) else len(of)
            rows = self.projection[place[lo:hi]] * weight[lo:hi, None]
            out[of[begins[k : k + 64]]] = np.add.reduceat(rows, begins[k : k + 64] - lo, axis=0)
        return _unit(out)

    def vote(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The share of label 1 among the nearest labelled vectors, by similarity; one half where none is similar."""
        out = []
        for lo in range(0, len(vectors), ROWS):
            alike = vectors[lo : lo + ROWS] @ self.vectors.T
            most = min(neighbours, alike.shape[1])
            near = np.argpartition(-alike, most - 1, axis=1)[:, :most]
            weight = np.maximum(np.take_along_axis(alike, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            out.append(np.where(total > 0, votes / np.where(total > 0, total, 1), 0.5))
        return np.concatenate(out) if out else np.zeros(0)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, latent: int = LATENT) -> Model:
    """A model from labelled (label, places, counts)."""
    x = np.zeros((len(rows), PLACES), np.float32)
    for k, (_, place, count) in enumerate(rows):
        x[k, place] = weights(np.zeros(len(place), np.int64), place, count, idf)
    # Subspace iteration with some directions to spare, then the leading right singular vectors inside it.
    basis = np.random.default_rng(0).standard_normal((PLACES, min(latent + SPARE, len(rows)))).astype(np.float32)
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    turn = np.linalg.svd(x @ basis, full_matrices=False)[2]
    basis = basis @ turn[:latent].T
    return Model(idf, basis, _unit(x @ basis), np.array([label for label, _, _ in rows]))


def held_out():
    """Column: the row is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    some, size = [], 0
    for lo in range(0, len(texts), 64):
        for text in texts.slice(lo, 64).to_pylist():
            text = text or ""
            if some and size + len(text) > SLICE:
                yield some
                some, size = [], 0
            some.append(text)
            size += len(text)
    if some:
        yield some


def document_frequencies(documents: DataFrame) -> np.ndarray:
    """In how many documents each place has a term, and behind it the number of documents with words; over all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PLACES + 1, np.int64)
        for batch in batches:
            for texts in _slices(batch.column(0)):
                of, place, _ = term_counts(texts)
                total[:PLACES] += np.bincount(place, minlength=PLACES)
                total[PLACES] += len(np.unique(of))
        yield pa.record_batch([pa.array(np.arange(PLACES + 1)), pa.array(total)], names=["place", "n"])

    counted = documents.select("text").where("text <> ''").mapInArrow(work, "place bigint, n bigint")
    # One row for each place.
    rows = counted.groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(PLACES + 1, np.int64)
    for place, n in rows:
        out[place] = n
    return out


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows that are not held out; None if there are not both labels.

    Takes at most ``sample`` documents of each label, by a hash of doc_id. A document labelled both
    ways counts as 0; of rows that share a doc_id the smallest text is taken. Only doc_id and quality
    of ``labels`` and doc_id and text of ``documents`` are read.
    """
    marked = (
        labels.select("doc_id", "quality")
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    known = marked.join(texts.select("doc_id").distinct(), "doc_id", "semi")
    some = None
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        some = part if some is None else some.unionByName(part)
    some = keep_files(documents.sparkSession, some, "quality-sample")
    # At most 2 * sample rows.
    mine = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, place, count = term_counts([batch.column(1)[k].as_py()])
                columns = [pa.array([v], t) for v, t in ((place, pa.list_(pa.int32())), (count, pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), *columns, batch.column(2).slice(k, 1)],
                    names=["quality", "places", "counts", "doc_id"],
                )

    terms = mine.selectExpr("CAST(quality AS int) AS quality", "text", "CAST(doc_id AS bigint) AS doc_id").mapInArrow(
        work, "quality int, places array<int>, counts array<int>, doc_id bigint"
    )
    # At most 2 * sample rows of at most PLACES numbers.
    found = terms.orderBy("doc_id").toArrow()
    rows = [
        (label, places.values.to_numpy(), counts.values.to_numpy())
        for label, places, counts in zip(found["quality"].to_pylist(), found["places"], found["counts"])
        if len(places)
    ]
    if len({label for label, _, _ in rows}) < 2:
        return None
    counted = document_frequencies(documents)
    idf = np.log((1 + counted[PLACES]) / (1 + counted[:PLACES])) + 1
    return fit(rows, idf)


_models: dict[int, Model] = {}


def score_texts(df: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for each row of ``df``. Without a model, and for texts without words, the score is 0.5."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    number = shared._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if number not in _models:
                _models.clear()
                _models[number] = shared.value
            own = _models[number]
            scores = [own.vote(own.latent(t)) if own else np.full(len(t), 0.5) for t in _slices(batch.column(1))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(run, "doc_id bigint, score double")


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``documents``.

    The score is near 1 for texts like those labelled 1. Null texts count as empty; texts without
    words have no neighbours and score 0.5, like all texts where the labels are not of both kinds.
    Null doc_ids are not held out and never learnt from; repeated rows each have a row. Other columns
    are not read. An empty table gives none.
    """
    return score_texts(documents, train(documents, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
