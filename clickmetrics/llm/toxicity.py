"""Toxicity by a support vector machine over a subsequence string kernel.

Two words are alike as far as they share letter pairs in order, near or with others between: a pair
at distance g weighs DECAY ** (g + 1). So an insult with letters put in or drawn apart stays near its
plain form. The normalised kernel goes through a Gaussian; Nyström landmarks (windows of the training
texts) turn it into a short vector, on which a linear machine with squared hinge loss is trained.
A sentence counts as toxic as its most toxic word, a text as its most toxic sentence.

Examples are windows of the labelled texts (words, long ones in stretches) with the label of their
text; a text's windows share its weight. All windows of the sample take part, in tasks; the driver
gets sums. The sample is bounded by the parameter ``SAMPLE`` for each label. Scoring is one pass over
all rows, with no shuffle as rows are independent. Words met before and their normal forms are kept, up
to a bound, so that forms of one word ("Word", "word,") are worked out once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmetrics.llm.common import CACHE_CHARS, CACHE_WORDS, keep_files, kept, map_batches

SAMPLE = 3000
FOLDS = 5
LANDMARKS = 128
DECAY = 0.7
GAP = 6
LETTERS = 40
SPAN = 32
# Letters of a window in training; with its two marks it fills SPAN.
STRETCH = SPAN - 2
SIGN = 99
SHARPNESS = 10.0
STEEP = 4.0
# Newton steps at most, the weight of the solution's length, and of all examples of a label.
STEPS = 20
RIDGE = 1e-2
WEIGHT = 1000
COST = 10
LOWEST = -4.0
# Words whose letter pairs are in memory at once: few enough for the processor's cache. No result depends on it.
PIECE = 256

# Letters drawn apart by blanks: three or more single characters in a row.
APART = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
# Found in each text that has such letters, and quickly ruled out in most others.
NEAR = re.compile(r" \S \S(?!\S)")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
LIKE = str.maketrans("0134578@$!", "oieastbasi")


def normal(word: str) -> str:
    return word.strip(EDGE).lower().translate(LIKE)


def normals(words: list[str]) -> list[str]:
    """``normal`` of each of many words, which hold no line feed."""
    text = "\n".join([word.strip(EDGE) for word in words]).lower()
    for sign, letter in LIKE.items():  # no letter is itself a sign, so one after the other is as at once
        text = text.replace(chr(sign), chr(letter))
    return text.split("\n") if words else []


def _codes(word: str) -> list[int]:
    """Letters as numbers below LETTERS, between marks for begin and end; signs are gaps without a number."""
    inner = [ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 12 if c.isalpha() else SIGN for c in word]
    return [LETTERS - 2, *inner, LETTERS - 1]


# The number of each character met so far.
_numbers = np.full(0x110000, -1, np.int8)


def _numbered(text: str) -> np.ndarray:
    """``_codes`` of all letters of a text, without marks."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    numbers = _numbers[points]
    if (numbers < 0).any():
        for point in set(points[numbers < 0].tolist()):
            _numbers[point] = _codes(chr(point))[1]
        numbers = _numbers[points]
    return numbers


def pair_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of gapped letter pairs, a unit-length row for each stretch of SPAN letters, and its word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    inner = np.ones(int(sizes.sum()), bool)
    inner[ends - sizes] = inner[ends - 1] = False
    letters = np.empty(len(inner), np.int64)
    letters[inner] = _numbered("".join(words))
    letters[ends - sizes], letters[ends - 1] = LETTERS - 2, LETTERS - 1
    # Stretches of a word overlap by half. Most words are one.
    half = SPAN // 2
    stretches = np.maximum(1, (sizes - 1) // half)
    owner = np.repeat(np.arange(len(words)), stretches)
    if len(owner) > len(words):
        number = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        starts = (ends - sizes)[owner] + half * number
        sizes = np.minimum(SPAN, ends[owner] - starts)
        letters = letters[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    row = np.repeat(np.arange(len(owner)), sizes)
    row[letters == SIGN] = -1
    left = (row * LETTERS + letters) * LETTERS
    index, weight = [], []
    for gap in range(1, GAP + 1):
        pair = (left[:-gap] + letters[gap:])[(row[:-gap] == row[gap:]) & (row[gap:] >= 0)]
        index.append(pair)
        weight.append(np.full(len(pair), DECAY ** (gap + 1)))
    flat = np.bincount(np.concatenate(index), np.concatenate(weight), len(owner) * LETTERS * LETTERS)
    features = flat.astype(np.float32).reshape(len(owner), LETTERS * LETTERS)
    features /= np.maximum(np.linalg.norm(features, axis=1, keepdims=True), 1e-9)
    return features, owner


class Model:
    """Landmark words and the weight of each one's kernel value."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float) -> None:
        self.landmarks, self.features = landmarks, pair_features(landmarks)[0]
        self.weights, self.bias = weights.astype(np.float32), float(bias)
        # Decision values of words and of their normal forms: of late, and of the time before.
        self.known: dict[str, float] = {}
        self.before: dict[str, float] = {}

    def kernel(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        features, owner = pair_features(words)
        return np.exp(SHARPNESS * (features @ self.features.T - 1)), owner

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision values; a very long word counts as its most toxic stretch."""
        out = np.full(len(words), LOWEST)
        for lo in range(0, len(words), PIECE):
            values, owner = self.kernel(words[lo : lo + PIECE])
            np.maximum.at(out, lo + owner, values @ self.weights + self.bias)
        return out

    def score_batch(self, texts: list[str]) -> list[float]:
        """Between 0 and 1 for each text; texts without words score as clean."""
        cut = [text.split() for text in texts]
        for text, words in zip(texts, cut):
            if NEAR.search(text):
                words += [m[0].replace(" ", "") for m in APART.finditer(text)]
        if len(self.known) > CACHE_WORDS // 2:  # words in use are taken over, the others go with the next change
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        every = set().union(*cut)
        here = dict(zip(every, map(known.get, every)))  # small beside the caches, so faster to look all words up in
        new = []
        for word in [w for w, value in here.items() if value is None]:
            if word in before:
                here[word] = known[word] = before[word]
            else:
                new.append(word)
        forms = normals(new)
        values = {form: known[form] if form in known else before.get(form) for form in forms}
        unknown = [form for form, value in values.items() if value is None]
        if unknown:
            values.update(zip(unknown, self.decide(unknown).tolist()))
        here.update(zip(new, map(values.__getitem__, forms)))
        known.update((f, value) for f, value in values.items() if len(f) <= CACHE_CHARS)
        known.update((w, here[w]) for w in new if len(w) <= CACHE_CHARS)
        highest = np.array([max(map(here.__getitem__, words), default=LOWEST) for words in cut])
        return (1 / (1 + np.exp(-STEEP * highest))).tolist()


def held_out():
    """Column: the row is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def windows_of(text: str) -> list[str]:
    """The distinct windows that a text is learnt from: its words in normal form, long ones in stretches that overlap."""
    forms = {normal(w) for w in text.split()} | {normal(m[0].replace(" ", "")) for m in APART.finditer(text)}
    out = set()
    for form in forms:
        for at in range(0, max(1, len(form) - STRETCH // 2), STRETCH // 2):
            out.add(form[at : at + STRETCH])
    return sorted(out - {""})


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows that are not held out; None if there are not both labels.

    Takes at most ``sample`` documents of each label, by a hash of doc_id. A document labelled both
    ways counts as toxic. Only doc_id and toxic of ``labels`` and doc_id and text of ``documents`` are read.
    """
    spark = documents.sparkSession
    marked = (
        labels.select("doc_id", "toxic")
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    some = None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        some = part if some is None else some.unionByName(part)
    # At most 2 * sample rows.
    texts = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").where("text IS NOT NULL")
    # Equal texts tell no more than one of them; all others stay.
    texts = texts.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))

    def cut(batch: pa.RecordBatch) -> list:
        own = [windows_of(t) for t in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array(own, pa.list_(pa.string()))]

    bags = map_batches(texts.select("toxic", "text"), cut, "toxic int, windows array<string>").where("size(windows) > 0")
    bags = keep_files(spark, bags, "toxic-bags")
    sizes = {r["toxic"]: r["count"] for r in bags.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    part = 1 / F.size("windows")
    counted = (
        bags.select("toxic", F.explode("windows").alias("window"), part.alias("part"))
        .groupBy("window")
        .agg(
            F.sum("toxic").alias("t"),
            F.sum(1 - F.col("toxic")).alias("c"),
            (F.sum(F.col("toxic") * F.col("part")) / sizes[1]).alias("toxic"),
            (F.sum((1 - F.col("toxic")) * F.col("part")) / sizes[0]).alias("clean"),
        )
    )
    counted = keep_files(spark, counted, "toxic-windows")
    probe = Model(_landmarks(counted, sizes), np.zeros(LANDMARKS), 0.0)
    own, _ = probe.kernel(probe.landmarks)
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    nystrom = vectors / np.sqrt(np.maximum(values, 1e-6))
    solution = _solve(keep_files(spark, _mapped(counted, probe, nystrom), "toxic-mapped"), len(nystrom) + 1)
    model = Model(probe.landmarks, nystrom @ solution[:-1], solution[-1])
    model.bias -= _threshold(_highest(bags, model).collect())  # one row a training text
    return model


def _landmarks(counted: DataFrame, sizes: dict[int, int]) -> list[str]:
    """Windows that tell of toxic texts, clean ones that resemble them, and any others."""
    share = F.col("t") / sizes[1] - F.col("c") / sizes[0]
    evidence = counted.where(share > 0).select("window", _evidence(sizes).alias("evidence"))
    marks = [r["window"] for r in evidence.orderBy(F.desc("evidence"), "window").limit(LANDMARKS // 2).collect()]
    clean = counted.where((share < 0) & ~F.col("window").isin(marks))
    alike = _decided(clean, Model(marks, np.ones(len(marks)), 0.0)).orderBy(F.desc("value"), "window")
    marks += [r["window"] for r in alike.limit(LANDMARKS // 4).collect()]
    rest = counted.where(~F.col("window").isin(marks)).orderBy(F.xxhash64("window"), "window")
    return marks + [r["window"] for r in rest.limit(LANDMARKS - len(marks)).collect()]


def _evidence(sizes: dict[int, int]):
    """The log-likelihood ratio that a window's share of the toxic texts is not that of all: sure above frequent."""
    every = sizes[0] + sizes[1]
    rate = (F.col("t") + F.col("c")) / every
    total = F.lit(0.0)
    for name, size in (("t", sizes[1]), ("c", sizes[0])):
        held = F.col(name)
        for seen, expected in ((held, rate * size), (size - held, (1 - rate) * size)):
            total += F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return total


def _decided(counted: DataFrame, model: Model) -> DataFrame:
    def work(batch: pa.RecordBatch) -> list:
        return [batch.column(0), pa.array(model.decide(batch.column(0).to_pylist()), pa.float64())]

    return map_batches(counted.select("window"), work, "window string, value double")


def _mapped(counted: DataFrame, probe: Model, nystrom: np.ndarray) -> DataFrame:
    """The weights of each window and its Nyström vector in half precision."""

    def work(batch: pa.RecordBatch) -> list:
        windows, vectors = batch.column(2).to_pylist(), []
        for lo in range(0, len(windows), PIECE):  # the letter pairs of all windows at once would be far more than their maps
            kernel, _ = probe.kernel(windows[lo : lo + PIECE])
            vectors += [v.tobytes() for v in (kernel @ nystrom).astype(np.float16)]
        return [batch.column(0), batch.column(1), pa.array(vectors, pa.binary())]

    return map_batches(counted.select("toxic", "clean", "window"), work, "toxic double, clean double, vector binary")


def _solve(mapped: DataFrame, width: int) -> np.ndarray:
    """Minimises RIDGE * |w|^2 / 2 + sum(weight * max(0, 1 - sign * x.w)^2) / 2 by Newton steps.

    A window is an example of each label that its texts have, weighted by its share of them, so that texts
    count alike and labels too. A step is one pass over the windows; a task answers with one row of sums.
    """
    penalty = RIDGE * np.eye(width)
    penalty[-1, -1] = 1e-6
    w = np.zeros(width)
    for _ in range(STEPS):

        def sums(batches, w=w):
            gradient, curve = np.zeros(width), np.zeros((width, width))
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float16).reshape(batch.num_rows, -1)
                x = np.hstack([x.astype(np.float64), np.ones((batch.num_rows, 1))])
                value = x @ w
                for sign, column in ((1.0, 0), (-1.0, 1)):
                    weight = batch.column(column).to_numpy()
                    slack = 1 - sign * value
                    active = (slack > 0) & (weight > 0)
                    xa = x[active] * (WEIGHT * weight[active])[:, None]
                    gradient -= xa.T @ (sign * slack[active])
                    curve += xa.T @ x[active]
            yield pa.RecordBatch.from_arrays(
                [pa.array([gradient.tobytes()], pa.binary()), pa.array([curve.tobytes()], pa.binary())], names=["gradient", "curve"]
            )

        gradient, curve = penalty @ w, penalty.copy()
        for r in mapped.mapInArrow(sums, "gradient binary, curve binary").collect():
            gradient += np.frombuffer(r["gradient"])
            curve += np.frombuffer(r["curve"]).reshape(curve.shape)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return w


def _highest(bags: DataFrame, model: Model) -> DataFrame:
    """The decision value of each training text: of its most toxic window."""

    def work(batch: pa.RecordBatch) -> list:
        lists = batch.column(1).to_pylist()
        windows = sorted(set().union(*lists))
        value = dict(zip(windows, model.decide(windows).tolist()))
        return [batch.column(0), pa.array([max(value[v] for v in own) for own in lists], pa.float64())]

    return map_batches(bags, work, "toxic int, value double")


def _threshold(rows: list) -> float:
    """The middle of the gap that costs least; a clean text lost counts as much as COST toxic ones missed."""
    values = np.array([r["value"] for r in rows])
    toxic = np.array([r["toxic"] for r in rows]) == 1
    order = np.argsort(values)
    values, toxic = values[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    lost = 1 - np.concatenate([[0], np.cumsum(~toxic)]) / max(1, (~toxic).sum())
    cuts = np.concatenate([[values[0] - 0.1], (values[1:] + values[:-1]) / 2, [values[-1] + 0.1]])
    cost = missed + COST * lost
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    # Among equal costs the widest gap.
    room = [min(values[k], 2.0) - values[k - 1] if 0 < k < len(values) else 0.1 for k in best]
    return float(cuts[best[int(np.argmax(room))]])


def score_texts(df: DataFrame, model: Model | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` (taken along as they are) and the score of its text. Null texts count as empty.

    Without a model (no labels to learn from) every text scores 0.
    """
    taken = df.select(*columns, F.col("text").alias("_scored_text"))
    return _scored(taken, model, df.select(*columns).schema, lambda batch: batch.column(batch.num_columns - 1))


def score_rows(df: DataFrame, model: Model | None) -> DataFrame:
    """(row, score): all columns of ``df`` as one, which hold the text that is scored."""
    place = [name.lower() for name in df.columns].index("text")
    rows = df.select(F.struct("*").alias("row"))
    return _scored(rows, model, rows.schema, lambda batch: pc.struct_field(batch.column(0), place))


def _scored(taken: DataFrame, model: Model | None, columns: T.StructType, text_of) -> DataFrame:
    shared = taken.sparkSession.sparkContext.broadcast(model)
    number = shared._jbroadcast.id()

    def run(batches):
        for batch in batches:
            own = kept(("toxicity", number), lambda: shared.value)
            column = text_of(batch)
            scores: list[float] = []
            for lo in range(0, batch.num_rows, 512):
                texts = [t or "" for t in column.slice(lo, 512).to_pylist()]
                scores += own.score_batch(texts) if own else [0.0] * len(texts)
            arrays = [batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores, pa.float64())], names=[*columns.names, "score"])

    schema = T.StructType([*columns.fields, T.StructField("score", T.DoubleType())])
    return taken.mapInArrow(run, schema)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``documents``.

    Null texts count as empty and score as clean; null doc_ids are not held out; repeated rows each
    have a row. Without labels of both kinds all scores are 0. Other columns are not read.
    """
    docs = documents.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    scored = score_texts(docs, train(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
