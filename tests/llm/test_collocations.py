"""Collocations against plain counting, over shards of several sizes."""

import random
import re
from collections import Counter

import pytest

from rankloom.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, support, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    out = []
    for lang in sorted(n):
        found = []
        for (language, words), a in f.items():
            if language != lang or len(words) < 2 or a < support:
                continue
            around = [m for (la, m), b in f.items() if la == lang and len(m) > len(words) and b >= support and 100 * b >= 80 * a]
            if any(words == m[i : i + len(words)] for m in around for i in range(len(m))):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def corpus():
    draw = random.Random(2)
    words = ["The", "of", "new", "york", "City", "état", "日本", "ha-ha", "a's", "x" * 19]
    rows = []
    for i in range(300):
        text = "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0b"]) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "fr", None]), draw.choice([text, text, text + " new york city hall", None, ""])))
    return rows


@pytest.mark.parametrize("shard_bytes", [1 << 30, 8000, 400])
def test_collocations_equal_plain_counting(spark, corpus, shard_bytes):
    """Local supports of 8, 3 and 1."""
    df = spark.createDataFrame(corpus, "lang string, text string").repartition(6)
    got = collocations.collocations(df, support=30, shard_bytes=shard_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(got) == sorted(plain(corpus, 30))


def test_only_the_best_are_returned(spark, corpus):
    df = spark.createDataFrame(corpus, "lang string, text string")
    assert found(collocations.collocations(df, support=10, top=7)) == sorted(plain(corpus, 10, 7))


def test_a_full_map_and_a_large_frequency_table(spark, corpus, monkeypatch):
    """A map whose bits are nearly all set, and joins without a broadcast, give the same."""
    monkeypatch.setattr(collocations, "is_small", lambda df: False)
    df = spark.createDataFrame(corpus, "lang string, text string").repartition(3)
    assert found(collocations.collocations(df, support=30, map_bits=6)) == sorted(plain(corpus, 30))


def test_words_are_the_same_whatever_the_slices(monkeypatch):
    texts = [f"{'y' * 100} {'z' * 300} End.. ,a\tb " * 4, "", "one two  One"] * 3
    encoded = [t.encode() for t in texts]
    whole = collocations.Words("en", list(encoded))
    monkeypatch.setattr(collocations, "SLICE", 64)
    cut = collocations.Words("en", list(encoded))
    for name in ("starts", "lengths", "hashes", "followed"):
        assert (getattr(whole, name) == getattr(cut, name)).all()
    assert len(set(whole.hashes.tolist())) == len({w for t in texts for w in re.findall(r"[^\x20\x09.,]+", t.lower())})


def test_collocations_of_odd_rows(odd):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert found(collocations.collocations(odd)) == sorted(plain(rows, 30))
    assert collocations.collocations(odd.limit(0)).collect() == []
