"""Suffix arrays and repeated passages against plain forms."""

import hashlib
import random

import numpy as np
import pytest

from rankloom.llm import passages
from rankloom.llm.suffix_array import permuted_common_prefixes, suffix_array


def test_suffix_array_and_prefixes_equal_sorting():
    draw = np.random.default_rng(3)
    for k in range(400):
        size, letters = draw.integers(1, 70), draw.choice([1, 2, 3, 200])
        body = draw.integers(1, letters + 1, size)
        if k % 4 == 0:
            body = np.tile(body[:5], 12)
        text = np.append(body, 0).astype(np.uint8)
        array = suffix_array(text)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        length = int(draw.integers(1, 20))
        shared = permuted_common_prefixes(text, array, length)
        for a, b in zip(array[1:], array[:-1]):
            pairs = list(zip(text[a:], text[b:]))
            want = next((i for i, (x, y) in enumerate(pairs) if x != y), len(pairs))
            assert shared[a] == min(want, length)


def plain(rows, length):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 by a dictionary of all windows."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if doc is not None else ():
            window = data[i : i + length]
            first[window] = min(first.get(window, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1) if doc is not None else ():
            if first[data[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("spans", "kept").collect()), key=str)


@pytest.mark.parametrize("length,hot", [(50, 4096), (13, 3), (8, 4096)])
def test_passages_equal_brute_force(spark, length, hot):
    draw = random.Random(length)
    words = ["alpha", "beta", "gam", "d", "eps", "zé", "日本"]
    base = [" ".join(draw.choices(words, k=draw.randint(0, 80))) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = []
        for b in draw.choices(base, k=3):
            at = draw.randint(0, max(0, len(b) - 1))
            parts.append(b[at : at + draw.randint(0, 200)])
        text = "".join(parts)
        rows.append((draw.choice([i, i, draw.randint(0, 40), None]), draw.choice([text, text, text, None, "", "a" * draw.randint(0, 1500)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(passages.repeated_passages(df, length, hot=hot)) == plain(rows, length)


@pytest.mark.parametrize("hot", [20, 50_000])
def test_a_common_passage_in_many_blocks(spark, hot):
    """One passage in every document: the smallest id keeps it, wherever that document lies."""
    draw = random.Random(1)
    common = "this passage of more than fifty bytes stands in every document of the table"
    rows = [(i, f"{draw.random()} {common} {draw.random()}") for i in range(300)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = found(passages.repeated_passages(df, hot=hot, block_bytes=2000))
    assert got == plain(rows, 50)
    assert sum(r[2] > 0 for r in got) == 299


def test_passages_of_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    short = [(d, t[:3000] if t else t) for d, t in rows]
    cut = odd.selectExpr("doc_id", "substring(text, 1, 3000) as text", "id", "part", "rejected")
    assert found(passages.repeated_passages(cut)) == plain(short, 50)
    assert passages.repeated_passages(odd).count() == len(rows)
    assert passages.repeated_passages(odd.limit(0)).collect() == []


def test_spans_and_kept_text(spark):
    shared = "x" * 20 + "0123456789" * 4
    df = spark.createDataFrame([(1, shared + "one"), (2, "two" + shared)], "doc_id long, text string")
    first, second = passages.repeated_passages(df, with_text=True).orderBy("doc_id").collect()
    assert (first["spans"], bytes(first["kept"]).decode()) == ([], shared + "one")
    assert (second["spans"], bytes(second["kept"]).decode()) == ([[3, 63]], "two")
