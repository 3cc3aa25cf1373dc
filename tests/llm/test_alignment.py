"""Token alignment against a plain version that compares byte ranges pair by pair."""

import hashlib
from collections import Counter

import pyarrow as pa

from clickmetrics.llm import alignment
from clickmetrics.llm.common import tokenizer_path

TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "The quick brown fox, über naïve. 執行 🙂",
    "don't <|endoftext|> stop </s> <unk> <0x41>",
    "▁ marks stay no spaces",
    "thnt thnt thnt  thnt\t\tthnt",
    "a" * 300,
    "\x00\x01 odd",
    "The quick brown fox, über naïve. 執行 🙂",
    "The quick brown foxes of and the",
]
ROWS = [*enumerate(TEXTS), (4, "again of id four"), (None, "the quick"), (None, None)]


def _plain(texts):
    """Per text: A ids, B ids, group text, linked id pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(tokenizer_path(alignment.FIRST))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.SECOND))
    byte_of = alignment._byte_of_letter()
    out = []
    for text in texts:
        spaced = " " + (text or "")
        a = a_side.encode(spaced, add_special_tokens=False).ids
        b = b_side.encode(text or "")
        a_raw = [bytes(byte_of[c] for c in a_side.id_to_token(i)) for i in a]
        b_raw = []
        for i in b:
            piece = b_side.id_to_piece(i)
            b_raw.append(bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(a_raw) != spaced.encode() or b"".join(b_raw) != spaced.encode():
            out.append(([], [], "", []))
            continue
        ranges = []
        for raw in (a_raw, b_raw):
            at = 0
            ranges.append([])
            for r in raw:
                ranges[-1].append((at, at + len(r)))
                at += len(r)
        links = [
            (x, y) for x, (p, q) in zip(a, ranges[0]) for y, (r, s) in zip(b, ranges[1]) if max(p, r) < min(q, s)
        ]
        groups, begin = [], 0
        for end in sorted({q for _, q in ranges[0]} & {s for _, s in ranges[1]}):
            sides = [
                ",".join(str(i) for i, (lo, hi) in zip(ids, own) if begin <= lo and hi <= end)
                for ids, own in ((a, ranges[0]), (b, ranges[1]))
            ]
            groups.append("|".join(sides))
            begin = end
        out.append((a, b, ";".join(groups), links))
    return out


def _expected(rows):
    plain = _plain([t for _, t in rows])
    counts = Counter(link for *_, links in plain for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(
        (
            (
                key,
                len(a),
                len(b),
                len(groups.split(";")) if groups else 0,
                len(links),
                sum(counts[link] == most[link[1]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for (key, _), (a, b, groups, links) in zip(rows, plain)
        ),
        key=repr,
    )


def _frame(spark, rows):
    names = "doc_id bigint, text string, block bigint, code string, pos int, value int, n_a int"
    return spark.createDataFrame([(i, t, 1, "c", 2, 3, 4) for i, t in rows], names).repartition(3)


def test_alignment_equals_byte_ranges(spark):
    result = alignment.align_documents(_frame(spark, ROWS))
    assert result.columns == [p.split()[0] for p in alignment.RESULT.split(", ")]
    assert sorted(map(tuple, result.collect()), key=repr) == _expected(ROWS)


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align_documents(empty).collect() == []
    nulls = _frame(spark, [(1, None), (2, ""), (2, "▁")])
    assert sorted(map(tuple, alignment.align_documents(nulls).collect())) == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]


def test_groups_as_texts(spark):
    found = {r["doc_id"]: r for r in alignment.token_groups(_frame(spark, ROWS[:8])).collect()}
    for (key, _), (a, b, groups, _) in zip(ROWS[:8], _plain([t for _, t in ROWS[:8]])):
        assert (found[key]["a"], found[key]["b"], found[key]["groups"]) == (a, b, groups)


def test_very_long_texts():
    """Stretches that the faster library may give up on come from the slower one, with the same ids."""
    from tokenizers import Tokenizer

    own = alignment.side(alignment.FIRST)
    slow = Tokenizer.from_file(tokenizer_path(alignment.FIRST))
    slow.encode_special_tokens = True
    for text in (" " * 300_000, " " + "ab" * 200_000, " x\n" * 100_000):
        assert own.encode([text])[0] == slow.encode(text, add_special_tokens=False).ids


def test_blocks_cut_between_documents_only(monkeypatch):
    """The same documents in one block and in many: links, groups and pair sums do not change."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in ROWS], pa.int64()), pa.array([t for _, t in ROWS], pa.string())], names=["doc_id", "text"]
    )
    seen = []
    for size in (alignment.BLOCK, 60, 1):
        monkeypatch.setattr(alignment, "BLOCK", size)
        monkeypatch.setattr(alignment, "SLICE", size)
        sums, docs, blocks = Counter(), [], 0
        for out in alignment._blocks(iter([batch]), alignment.FIRST, alignment.SECOND):
            row = {n: out.column(n)[0].as_py() for n in out.schema.names}
            sums.update(dict(zip(row["codes"], row["sums"])))
            docs += zip(row["doc_ids"], *(row[c] for c in alignment.COUNTS), row["sha"])
            blocks += 1
        seen.append((sums, docs, blocks))
    assert seen[0][:2] == seen[1][:2] == seen[2][:2]
    assert seen[0][2] == 1 and seen[2][2] > seen[1][2] > 1
