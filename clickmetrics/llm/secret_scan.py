"""Secret scans: known shapes, and windows of high entropy.

Known shapes (keyword assignments, access ids, long hexadecimal runs) come first. Then every run of
token characters is slid over with a window: the counts of its characters are kept up as one enters
and one leaves, and with them the Shannon entropy, for each character class by its own threshold.
Windows above it become spans unless an allow-list knows the run (plain words, numbers, UUIDs,
paths). Known shapes and placeholders inside a run are cut out of its spans; what is left of them
stays, except between two cuts what the allow-list knows. One pass, no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from clickmetrics.llm.common import map_batches

# The known shapes, and how long their matches must be.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Class, what a run must consist of, and bits a character from which a window counts.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F-]+"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 3.7),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9),
)
ALLOWED = re.compile(
    r"[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]*"  # words, paths
    r"|[0-9]+([-_/=+][0-9]+)*"  # numbers, dates
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
)
# Excuses its own letters, not the run around it.
PLACEHOLDER = re.compile(r"EXAMPLE|example|PLACEHOLDER|placeholder|X{4,}|x{4,}|0{7,}|1234567(?:890?)?")
_N_LOG_N = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def entropy_spans(run: str, window: int = WINDOW, threshold: float | None = None) -> list[tuple[int, int]]:
    """Stretches of ``run`` covered by windows whose entropy reaches the threshold of the run's class."""
    if threshold is None:
        threshold = next(bits for _, shape, bits in CLASSES if shape.fullmatch(run))
    n_log_n = _N_LOG_N if window == WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    weight, spans = 0.0, []
    for at, letter in enumerate(run):
        if at >= window:
            gone = run[at - window]
            n = counts[gone]
            weight += n_log_n[n - 1] - n_log_n[n]
            counts[gone] = n - 1
        n = counts.get(letter, 0)
        weight += n_log_n[n + 1] - n_log_n[n]
        counts[letter] = n + 1
        if at >= window - 1 and math.log2(window) - weight / window >= threshold - 1e-9:
            begin = at - window + 1
            if spans and begin <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((begin, at + 1))
    return spans


def _free(text: str, start: int, end: int, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of the run from ``start`` to ``end`` beside its known spans, placeholders and what the allow-list knows."""
    cuts = [m.span() for m in PLACEHOLDER.finditer(text, start, end)]
    free, at = [], start
    for a, b in [*sorted(cuts + known), (end, end)]:
        part = text[at:a].strip("-_/=+")
        if part and not ALLOWED.fullmatch(part):
            free.append((at, a))
        at = max(at, b)
    return free


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """In order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _common(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where spans of two ordered lists overlap, in one walk over both."""
    out, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        a, b = max(left[i][0], right[j][0]), min(left[i][1], right[j][1])
        if a < b:
            out.append((a, b))
        if left[i][1] < right[j][1]:
            i += 1
        else:
            j += 1
    return out


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; code points, end exclusive. A null text has none."""
    if not text:
        return []
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    known, at = _merged([(a, b) for a, b, _ in found]), 0
    for m in CANDIDATE.finditer(text):
        # Runs and known spans both go on to the right, so each is passed once.
        while at < len(known) and known[at][1] <= m.start():
            at += 1
        if ALLOWED.fullmatch(m[0]):
            continue
        spans = [(a + m.start(), b + m.start()) for a, b in entropy_spans(m[0])]
        if spans:
            last = at
            while last < len(known) and known[last][0] < m.end():
                last += 1
            free = _free(text, m.start(), m.end(), known[at:last])
            found += [(a, b, "entropy") for a, b in _common(spans, free)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str, mark: str = "[{kind}]") -> str:
    """The text with every secret replaced; spans that overlap become one mark, of the first kind."""
    out, at = [], 0
    for start, end, kind in find_secrets(text):
        if start >= at:
            out += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(df: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row for each row of ``df``.

    Null texts count as empty; null and repeated doc_ids stay; other columns are not read.
    """

    def work(batch: pa.RecordBatch) -> list:
        rows = [find_secrets(t.as_py()) for t in batch.column(1)]
        base = [[s for s in spans if s[2] != "entropy"] for spans in rows]
        counts = [[sum(s[2] == kind for s in spans) for spans in base] for kind in KINDS[:3]]
        return [
            batch.column(0),
            *[pa.array(c, pa.int64()) for c in counts],
            pa.array([hashlib.sha256(_listed(s).encode()).hexdigest() for s in base], pa.string()),
            pa.array([_listed(s) for s in rows], pa.string()),
        ]

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_batches(df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text"), work, schema)


def redact_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with secrets replaced in its text column; null texts stay null, other columns as they are."""

    def run(batches):
        for batch in batches:
            k = batch.schema.get_field_index(text)
            old = batch.column(k)
            new = [None if t is None else redact(t) for t in old.to_pylist()]
            yield batch.set_column(k, batch.schema.field(k), pa.array(new, old.type))

    return df.mapInArrow(run, df.schema)
