"""Removal of repeated strings against a set of all strings."""

import hashlib

import pytest
from logweir.llm.repeats import remove_repeats

from tests.llm.rows import ODD, clashing, corpus, documents, sentence


def brute(rows, length=100):
    seen, out = set(), {}
    for d, text, *_ in sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: r[0]):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            part = body[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(x for x, g in zip(body, gone) if not g)
        spans = sum(g and not gone[i - 1] if i else g for i, g in enumerate(gone))
        out[d] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df, **options):
    return {r.doc_id: tuple(r)[1:5] for r in remove_repeats(df, **options).collect()}


@pytest.mark.parametrize("length", [100, 40, 158])
def test_all_strings(spark, length):
    rows = [*corpus(4, 40), *[r for r in ODD if r[0] != 905], (905, "word " * 300, "", "", 0)]
    assert result(documents(spark, rows), length=length) == brute(rows, length)


def test_overlaps_and_edges(spark):
    import random

    passage = sentence(random.Random(2), 25)
    cut = passage.encode()[:100].decode()
    texts = [passage, passage, "x" + passage, passage[:-1], "y" * 350, "y" * 99, "y" * 100, cut, cut[:-1], "é" * 80, "é" * 80, "ab" * 200, passage + passage]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    assert result(documents(spark, rows)) == brute(rows)


def test_kept_text_repeats_and_clashes(spark):
    rows = [(1, "z" * 10, "", "", 0), (2, "abc " * 40, "", "", 0), (3, "q" + "abc " * 40 + "!", "", "", 0), (3, "q" + "abc " * 40 + "!", "", "", 0)]
    df = clashing(documents(spark, rows), "at", "removed", "body", "n_bytes")
    got = sorted((r.doc_id, r.n_removed, r.kept_text) for r in remove_repeats(df, with_text=True).collect())
    assert [g[0] for g in got] == [1, 2, 3, 3]
    assert got[0][2] == "z" * 10 and got[2] == got[3] and got[2][2] == "q!"


def test_lengths(spark):
    with pytest.raises(ValueError):
        remove_repeats(documents(spark, []), length=20)
    assert result(documents(spark, [])) == {}
