"""Encoding texts to SentencePiece ids and back.

BPE merges are never replayed over a text. A sequence of pieces is what merging would give exactly
if every two neighbours are compatible, so the encoder walks from left to right over the longest
matches an Aho-Corasick automaton finds, asks for each neighbour pair whether merging could have
left it that way, takes the next shorter piece where not, and steps back where no piece fits.
Positions from which no way leads on are kept in a bit field and never tried again, which bounds
the work by text length times piece length.

Rows are independent: no shuffle, one pass, memory of one batch and a bounded cache of words.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickmetrics.llm.common import CACHE_CHARS, CACHE_WORDS, map_batches, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
BEFORE_ALL = 1 << 60


class PieceCodec:
    """Encodes and decodes with a BPE model file that has byte fallback and no text rewriting."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.normalize(" a  ﬁ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}ﬁ":
            raise ValueError("only models that leave texts as they are, but for a first space, are supported")
        size = model.get_piece_size()
        self.bos, self.eos = model.bos_id(), model.eos_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = [0] * 256
        self.output: list[bytes] = []
        normal = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.output.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i):
                self.output.append(b"")
            elif model.is_unknown(i):
                self.output.append(" ⁇ ".encode())
            else:
                normal.append(i)
                self.output.append(piece.replace(SPACE, " ").encode())
        self.is_byte = [model.is_byte(i) for i in range(size)]
        self._compile(normal, model)
        self.words = _Cache(self._key)

    def _compile(self, normal: list[int], model) -> None:
        """Merge ranks, the merge that makes each piece, and the automaton."""
        multi = sorted((i for i in normal if len(self.pieces[i]) > 1), key=lambda i: -model.get_score(i))
        single = [i for i in normal if len(self.pieces[i]) == 1]
        self.rank = {i: k for k, i in enumerate(single + multi)}
        by_text = {self.pieces[i]: i for i in normal}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for i in multi:
            pair = _last_merge(self.pieces[i], by_text, self.rank)
            if pair:
                self.parts[i] = pair
                self.merges[pair] = i
        reached = {self.pieces[i]: i for i in [*single, *self.parts]}
        self.length = [len(p) for p in self.pieces]
        self.shorter = {
            i: next((reached[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in reached), None)
            for p, i in reached.items()
        }
        self.automaton = ahocorasick.Automaton()
        for p, i in reached.items():
            self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        # No piece goes on past a space or across a line end: then words and lines are encoded one by one.
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in reached)
        self.cut_lines = not any("\n" in p for p in by_text)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces side by side: no merge across their border comes first."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > CACHE_WORDS:
                self.fits.clear()
            known = self.fits[left, right] = self._stays(left, right)
        return known

    def _stays(self, left: int, right: int) -> bool:
        rank, parts, limit = self.rank, self.parts, BEFORE_ALL
        while True:
            joined = self.merges.get((left, right))
            if joined is not None and rank[joined] < limit:
                return False
            undo_left = left in parts and (right not in parts or rank[left] > rank[right])
            if undo_left:
                limit, left = rank[left], parts[left][1]
            elif right in parts:
                limit, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def _segment(self, text: str) -> bytes:
        """Ids of a text that already has its space marks; characters without a piece become bytes."""
        longest: list[int | None] = [None] * len(text)
        for end, (back, piece) in self.automaton.iter(text):
            longest[end - back] = piece  # matches come by their ends, so the longest is last
        if None not in longest:
            return array("I", self._backtrack(longest)).tobytes()
        ids: list[int] = []
        at = 0
        while at < len(text):
            stop = at
            while stop < len(text) and longest[stop] is not None:
                stop += 1
            ids += self._backtrack(longest[at:stop])
            at = stop
            if at < len(text):
                ids += [self.byte_ids[b] for b in text[at].encode("utf-8", "replace")]
                at += 1
        return array("I", ids).tobytes()

    def _backtrack(self, longest: list[int | None]) -> list[int]:
        """The compatible sequence over a stretch, given the longest piece at each of its positions."""
        length, shorter, fits, end = self.length, self.shorter, self.fits, len(longest)
        dead = bytearray(end // 8 + 1)
        chosen: list[int] = []
        left, at = -1, 0
        piece = longest[0] if end else None
        while at < end:
            while piece is not None:
                stop = at + length[piece]
                if not dead[stop >> 3] >> (stop & 7) & 1 and (
                    left < 0 or fits.get((left, piece)) or self._compatible(left, piece)
                ):
                    break
                piece = shorter[piece]
            if piece is not None:
                chosen.append(piece)
                left, at = piece, stop
                piece = longest[at] if at < end else None
            else:
                dead[at >> 3] |= 1 << (at & 7)
                piece = chosen.pop()
                at -= length[piece]
                left = chosen[-1] if chosen else -1
        return chosen

    def encode_bytes(self, text: str | None, ends: bool = False) -> bytes:
        """Ids as little-endian 32-bit words, with begin and end ids on request."""
        text = (text or "").replace(SPACE, " ")
        if not text:
            body = b""
        elif not self.cut_spaces:
            body = self._segment(SPACE + text.replace(" ", SPACE))
        elif "  " in text or " \n" in text or text[0] == " " or text[-1] == " " or not self.cut_lines:
            keys = [part[1:] for part in re.findall(" *[^ ]+| +", " " + text)]
            body = b"".join(map(self._word if self.cut_lines else self.words.__getitem__, keys))
        else:
            body = b"".join(map(self.words.__getitem__, text.replace("\n", " \n").split(" ")))
        if not ends:
            return body
        return self.bos.to_bytes(4, "little") + body + self.eos.to_bytes(4, "little")

    def _key(self, key: str) -> bytes:
        """Ids of a word behind a space, or, if the key starts with a line end, of the line end and what follows."""
        if self.cut_lines and key.startswith("\n"):
            return self.byte_ids[10].to_bytes(4, "little") + self._segment(key[1:].replace(" ", SPACE))
        return self._segment(SPACE + key.replace(" ", SPACE))

    def _word(self, key: str) -> bytes:
        first, *rests = key.split("\n")
        return self.words[first] + b"".join(self.words["\n" + r] for r in rests)

    def encode(self, text: str | None, ends: bool = False) -> list[int]:
        return np.frombuffer(self.encode_bytes(text, ends), "<u4").tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text. Byte pieces that are no valid UTF-8 become U+FFFD, one for each byte."""
        raw = b"".join(map(self.output.__getitem__, ids))
        first = next((i for i in ids if self.output[i]), None)
        if first is not None and self.pieces[first].startswith(SPACE):
            raw = raw[1:]
        try:
            raw.decode()
        except UnicodeDecodeError:
            out, run = [], bytearray()
            for k, i in enumerate([*ids, self.eos]):
                if self.is_byte[i]:
                    run += self.output[i]
                    continue
                out.append(re.sub("[\udc80-\udcff]", "�", run.decode("utf-8", "surrogateescape")).encode())
                run.clear()
                out.append(self.output[i])
            raw = b"".join(out)
            if first is not None and self.pieces[first].startswith(SPACE):
                raw = raw[1:]
        return raw

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode()


class _Cache(dict):
    """Results by word; bounded by starting afresh, and closed to very long words."""

    def __init__(self, work) -> None:
        self.work = work

    def __missing__(self, key: str) -> bytes:
        result = self.work(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[key] = result
        return result


def _last_merge(piece: str, by_text: dict[str, int], rank: dict[int, int]) -> tuple[int, int] | None:
    """The two pieces whose merge makes ``piece`` when it is encoded alone; None if merging never makes it."""
    symbols = list(piece)
    while len(symbols) > 2:
        pairs = [by_text.get(a + b) for a, b in zip(symbols, symbols[1:])]
        best = min((p for p in pairs if p is not None), key=rank.__getitem__, default=None)
        if best is None or len(symbols) == 2:
            return None
        k = pairs.index(best)
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
    left, right = by_text.get(symbols[0]), by_text.get(symbols[-1])
    return (left, right) if len(symbols) == 2 and left is not None and right is not None else None


_codecs: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    """The codec of a file, built once in a worker."""
    if model not in _codecs:
        _codecs[model] = PieceCodec(model if "/" in model else tokenizer_path(model))
    return _codecs[model]


def encode_texts(df: DataFrame, text: str = "text", key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(key, ids array): every whole text of ``df`` with begin and end ids. A null text counts as empty."""

    def work(batch: pa.RecordBatch) -> list:
        own = codec(model)
        blobs = [own.encode_bytes(t, ends=True) for t in batch.column(1).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
        ids = np.frombuffer(b"".join(blobs), "<u4").astype(np.int32)
        return [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]

    return map_batches(df.select(key, text), work, f"{key} {df.schema[key].dataType.simpleString()}, ids array<int>")


def decode_ids(df: DataFrame, ids: str = "ids", key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(key, text) from an id array column. A null array gives an empty text."""

    def work(batch: pa.RecordBatch) -> list:
        own = codec(model)
        return [batch.column(0), pa.array([own.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())]

    return map_batches(df.select(key, ids), work, f"{key} {df.schema[key].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each row of ``df``.

    Encodes every whole text with begin and end ids and decodes the ids again in the same task.
    Null texts count as empty; null and repeated doc_ids stay; other columns are not read.
    """

    def work(batch: pa.RecordBatch) -> list:
        own = codec(model)
        counts, coded, decoded = [], [], []
        for text in batch.column(1):
            blob = own.encode_bytes(text.as_py(), ends=True)
            ids = np.frombuffer(blob, "<u4").tolist()
            counts.append(len(ids))
            coded.append(hashlib.sha256(blob).hexdigest())
            decoded.append(hashlib.sha256(own.decode_bytes(ids)).hexdigest())
        return [
            batch.column(0),
            pa.array(counts, pa.int64()),
            pa.array(coded, pa.string()),
            pa.array(decoded, pa.string()),
        ]

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text"), work, schema)
