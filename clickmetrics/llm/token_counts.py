"""Token counts by a compiled finite-state tokenizer.

The tokenizer becomes deterministic transducers whose transitions carry the number of tokens they
emit. One cuts a word into letter runs, digits, other runs and contractions; one for each run reads
the run's bytes. Its state is what later merges can still change: the longest suffix that starts
some vocabulary entry, with the last token and the count at each place in it. Counts of places
further back are final and leave on the transition (they can be negative, as a merge may lower a
count). Transitions are compiled when first taken and kept; a table that outgrows its bound starts
afresh. Words met before are kept as ready-made transitions from the start state back to it.

Texts longer than ``CHUNK`` characters are cut and the chunks spread over tasks. A chunk's state map
is (open head, count, open tail): blanks bring every state back to the start, so only what lies
before the first and behind the last blank depends on its neighbours. Maps compose associatively,
so they are scanned in chunk order for each document.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import CACHE_CHARS, CACHE_WORDS, map_batches, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 1 << 16
BLANKS = " \n\t\r"
# The white space of Unicode, and the contractions the tokenizer's pattern takes first.
WHITE = frozenset("\t\n\v\f\r \x85\xa0                　")
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
STOPS = ".,;:!?"
END = "</w>"
BEFORE_ALL = 1 << 60


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class RunTransducer:
    """Counts the BPE tokens of a run of bytes that is closed by an end-of-word mark."""

    def __init__(self, merges: list[list[str]]) -> None:
        self.letters = _byte_letters()
        self.rank: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for k, (a, b) in enumerate(merges):
            # A token that an earlier merge makes already is never made by this one.
            if a + b not in self.parts:
                self.rank[a + b] = k
                self.parts[a + b] = (a, b)
        self.joins = {pair: token for token, pair in self.parts.items()}
        self.prefixes = {self._plain(t)[:n] for t in self.parts for n in range(1, len(self._plain(t)) + 1)}
        self._reset()

    @staticmethod
    def _plain(token: str) -> str:
        """The token with its end mark as one symbol."""
        return token.replace(END, "\0")

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        self.ends: dict[tuple[int, str], int] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.start = self._number(("", (None,), (0,)))

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def _stays(self, left: str, right: str) -> bool:
        """Whether merging leaves the two tokens side by side."""
        rank, parts, limit = self.rank, self.parts, BEFORE_ALL
        while True:
            joined = self.joins.get((left, right))
            if joined is not None and rank[joined] < limit:
                return False
            if left in parts and (right not in parts or rank[left] > rank[right]):
                limit, left = rank[left], parts[left][1]
            elif right in parts:
                limit, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def _fit(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        known = self.fits.get((left, right))
        if known is None:
            known = self.fits[left, right] = self._stays(left, right)
        return known

    def _last(self, state: tuple, symbol: str) -> tuple[str, int]:
        """The token that ends with ``symbol``, and the count with it."""
        seen, lasts, counts = state
        text = seen + symbol
        for begin in range(len(text)):
            token = text[begin:]
            if (len(token) - (len(symbol) - 1) == 1 or token in self.parts) and self._fit(lasts[begin], token):
                return token, counts[begin] + 1
        raise AssertionError("a single symbol always fits")

    def step(self, state: int, letter: str) -> tuple[int, int]:
        found = self.steps.get((state, letter))
        if found is None:
            own = self.states[state]
            token, count = self._last(own, letter)
            text = own[0] + letter
            moved = next(k for k in range(len(text) + 1) if k == len(text) or text[k:] in self.prefixes)
            lasts, counts = (*own[1], token)[moved:], (*own[2], count)[moved:]
            after = self._number((text[moved:], lasts, tuple(c - counts[0] for c in counts)))
            found = self.steps[state, letter] = (after, counts[0])
        return found

    def end(self, state: int, letter: str) -> int:
        found = self.ends.get((state, letter))
        if found is None:
            found = self.ends[state, letter] = self._last(self.states[state], letter + END)[1]
        return found

    def count(self, run: bytes) -> int:
        if len(self.steps) > CACHE_WORDS:
            self._reset()
        letters, step, state, total = self.letters, self.step, self.start, 0
        for b in run[:-1]:
            state, emitted = step(state, letters[b])
            total += emitted
        return total + self.end(state, letters[run[-1]]) if run else 0


class Counter:
    """Counts of words and chunks for one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        model = spec["model"]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != END or model["ignore_merges"]:
            raise ValueError("only byte-level BPE with word ends, lower case and dropped white space is supported")
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        self.runs = RunTransducer(model["merges"])
        self.kinds: dict[str, str] = {}
        self.words: dict[str, int] = {"": 0}

    def _kind(self, letter: str) -> str:
        kind = "white" if letter in WHITE else unicodedata.category(letter)[0]
        kind = self.kinds[letter] = kind if kind in ("white", "L", "N") else "other"
        return kind

    def word(self, word: str) -> int:
        """Tokens of a word without blanks, as the tokenizer counts them."""
        if self.special is None or "<|" not in word:
            return self._plain_word(word)
        plain, total, at = self.special.finditer(word), 0, 0
        for match in plain:
            total += self._plain_word(word[at : match.start()]) + 1
            at = match.end()
        return total + self._plain_word(word[at:])

    def _plain_word(self, word: str) -> int:
        if word and word[-1] in STOPS and word[:-1].isalpha() and len(word.lower()) == len(word):
            return self[word[:-1]] + 1  # a stop is one token, apart from the letters before it
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
            word = "".join([c.lower() for c in word])
        else:
            word = word.lower()
        count, kinds = self.runs.count, self.kinds
        total = begin = at = 0
        mode = ""
        size = len(word)
        while at < size:
            letter = word[at]
            kind = kinds.get(letter) or self._kind(letter)
            if kind != mode or kind == "N":
                if mode and mode != "white":
                    total += count(word[begin:at].encode())
                begin, mode = at, kind
                if letter == "'":
                    tail = next((c for c in CONTRACTIONS if word.startswith(c, at + 1)), None)
                    if tail:
                        total += count(("'" + tail).encode())
                        at += 1 + len(tail)
                        begin, mode = at, ""
                        continue
            at += 1
        if mode and mode != "white":
            total += count(word[begin:].encode())
        return total

    def __getitem__(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.word(word)
            if len(word) <= CACHE_CHARS:
                if len(self.words) > CACHE_WORDS:
                    self.words = {"": 0}
                self.words[word] = n
        return n

    def words_of(self, text: str) -> list[str]:
        for blank in BLANKS[1:]:
            text = text.replace(blank, " ")
        return text.split(" ")

    def count(self, words: list[str]) -> int:
        try:
            return sum(map(self.words.__getitem__, words))
        except KeyError:
            return sum(map(self.__getitem__, words))

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, count, tail): what is open at both ends and what is counted between. No tail: no blank."""
        words = self.words_of(chunk)
        if len(words) == 1:
            return words[0], 0, None
        return words[0], self.count(words[1:-1]), words[-1]

    def compose(self, a: tuple[str, int, str | None], b: tuple[str, int, str | None]) -> tuple[str, int, str | None]:
        """The map of two neighbouring chunks from their maps; associative."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        if b[2] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + b[1] + self[a[2] + b[0]], b[2]

    def whole(self, maps: list[tuple[str, int, str | None]]) -> tuple[str, int, str | None]:
        """The map of all chunks: the rising half of a prefix scan, neighbours by neighbours.

        The other prefixes are not wanted; of a text without a blank each would hold all that is before it.
        """
        maps = list(maps)
        while len(maps) > 1:
            maps = [self.compose(*maps[k : k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        return maps[0]

    def close(self, whole: tuple[str, int, str | None]) -> int:
        return self[whole[0]] + whole[1] + (self[whole[2]] if whole[2] is not None else 0)


_counters: dict[str, Counter] = {}


def counter(name: str) -> Counter:
    if name not in _counters:
        _counters[name] = Counter(name if "/" in name else tokenizer_path(name))
    return _counters[name]


def chunk_maps(df: DataFrame, tokenizer: str, chunk: int) -> DataFrame:
    """One row for each chunk of each row: (key, k, head, n, tail). Rows without text have one empty chunk."""
    cut = "transform(sequence(0, greatest(length(text) - 1, 0) div {c}), i -> substring(text, i * {c} + 1, {c}))"
    pieces = df.select(
        "key", F.posexplode(F.expr(f"CASE WHEN length(text) > {chunk} THEN {cut.format(c=chunk)} ELSE array(text) END"))
    )

    def work(batch: pa.RecordBatch) -> list:
        own = counter(tokenizer)
        maps = [own.chunk_map(t or "") for t in batch.column(2).to_pylist()]
        return [
            batch.column(0),
            batch.column(1),
            pa.array([m[0] for m in maps], pa.string()),
            pa.array([m[1] for m in maps], pa.int64()),
            pa.array([m[2] for m in maps], pa.string()),
        ]

    kind = df.schema["key"].dataType.simpleString()
    return map_batches(pieces.select("key", "pos", "col"), work, f"key {kind}, k int, head string, n bigint, tail string")


def count_tokens(df: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``df``.

    Whole texts, without added special tokens; special strings inside a text count as one token. Null
    texts count as empty; null doc_ids stay; other columns are not read. Rows that agree in doc_id and
    text are told apart by number only, so each comes back.
    """
    # What identifies a row is its content, so a task that runs twice gives the same keys.
    keyed = df.selectExpr(
        "struct(CAST(doc_id AS bigint) AS doc_id, xxhash64(text) AS h, octet_length(coalesce(text, '')) AS n_bytes) AS key",
        "coalesce(text, '') AS text",
    )
    flat = chunk_maps(keyed.selectExpr("to_json(key) AS key", "text"), tokenizer, chunk)
    gathered = flat.groupBy("key", "k").agg(
        F.count("*").alias("copies"), F.first("head").alias("head"), F.first("n").alias("n"), F.first("tail").alias("tail")
    ).groupBy("key").agg(
        F.max("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", "head", "n", "tail"))).alias("maps")
    )

    def work(batch: pa.RecordBatch) -> list:
        own = counter(tokenizer)
        totals = []
        for maps in batch.column(2).to_pylist():
            totals.append(own.close(own.whole([(m["head"], m["n"], m["tail"]) for m in maps])))
        return [batch.column(0), batch.column(1), pa.array(totals, pa.int64())]

    counted = map_batches(gathered, work, "key string, copies bigint, n_tokens bigint")
    key = F.from_json("key", "doc_id bigint, h bigint, n_bytes bigint")
    return (
        counted.select(key.alias("key"), "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("key.doc_id", "key.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
