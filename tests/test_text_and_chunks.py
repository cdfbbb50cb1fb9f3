import pytest
from pyspark.sql import functions as F

from rankloom.functions import text as T
from rankloom.operators import chunking


def docs(spark, *texts):
    return spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], "doc_id bigint, topic string, text string")


def pieces(df):
    return [(r.doc_id, r.chunk_index, r.text) for r in df.orderBy("doc_id", "chunk_index").collect()]


@pytest.mark.parametrize(
    ("text", "size", "overlap", "expected"),
    [
        ("", 4, 1, []),
        ("  \n ", 4, 1, []),
        ("a b c d", 4, 1, ["a b c d"]),
        ("a b c d e", 4, 1, ["a b c d", "d e"]),
        ("a b c d e", 2, 0, ["a b", "c d", "e"]),
        ("a\t b c\n", 8, 2, ["a b c"]),
    ],
)
def test_fixed_chunks(spark, text, size, overlap, expected):
    got = pieces(chunking.fixed_chunks(docs(spark, text), size, overlap))
    assert [p[2] for p in got] == expected
    assert [p[1] for p in got] == list(range(len(expected)))


def brute_chunks(text, size, overlap):
    tokens = text.split()
    out, start = [], 0
    while tokens:
        out.append(" ".join(tokens[start : start + size]))
        if start + size >= len(tokens):
            break
        start += size - overlap
    return out


def test_fixed_chunks_against_brute_force(spark):
    texts = [" ".join(f"w{j}" for j in range(n)) for n in range(0, 40)]
    for size, overlap in ((7, 3), (5, 0), (8, 7)):
        got = pieces(chunking.fixed_chunks(docs(spark, *texts), size, overlap))
        want = [(i, j, c) for i, t in enumerate(texts) for j, c in enumerate(brute_chunks(t, size, overlap))]
        assert got == want


def test_bad_config_fails_before_running(spark):
    with pytest.raises(ValueError):
        chunking.fixed_chunks(docs(spark, "a b c"), 2, 2)


def test_equal_texts_share_an_id_and_keep_their_rows(spark):
    chunks = chunking.fixed_chunks(docs(spark, "x", "x"), 4, 0)
    assert chunks.count() == 2
    kept = chunking.distinct_content(chunks).collect()
    assert [(r.doc_id, r.copies) for r in kept] == [(0, 2)]


def test_sweep_agrees_with_real_chunks(spark):
    texts = [" ".join("w" for _ in range(n)) for n in (0, 1, 9, 10, 11, 25, 63)]
    frame = docs(spark, *texts)
    for row in chunking.size_sweep(frame, [(10, 3), (16, 0)]).collect():
        chunks = chunking.fixed_chunks(frame, row["size"], row["overlap"])
        stats = chunks.agg(F.count("*"), F.round(F.avg("n_tokens_ws"), 1), F.max("n_tokens_ws")).first()
        assert (row.n_chunks, row.avg_len, row.max_len) == tuple(stats)
        assert row.chunks_per_doc == round(row.n_chunks / len(texts), 2)


def test_counts_include_documents_without_tokens(spark):
    frame = docs(spark, "", "a b c")
    row = chunking.ingest_counts(frame, chunking.fixed_chunks(frame, 2, 0)).first()
    assert tuple(row) == (2, 2, 1.0)


def test_sentence_chunks(spark):
    text = "One two. Three four five! Six? " + "long " * 12 + "end. Tail"
    got = [p[2] for p in pieces(chunking.sentence_chunks(docs(spark, text, ""), 6))]
    assert got == ["One two. Three four five! Six?", ("long " * 12 + "end."), "Tail"]


def test_strategy_guard(spark):
    good = chunking.fixed_chunks(docs(spark, "a b"), 4, 0, strategy="s1")
    assert chunking.one_strategy(good, "s1").count() == 1
    mixed = good.unionByName(chunking.fixed_chunks(docs(spark, "a b"), 4, 0, strategy="s2"))
    with pytest.raises(Exception, match="expected chunk strategy s1"):
        chunking.one_strategy(mixed, "s1").collect()


def test_text_functions(spark):
    row = (
        spark.range(1)
        .select(
            T.word_terms(F.lit("Err-42 Café")).alias("terms"),
            T.content_key(F.lit("abc")).alias("key"),
            T.preview(F.lit("a\nb")).alias("short"),
            T.preview(F.lit("x" * 161)).alias("cut"),
            T.preview(F.lit("x" * 160)).alias("whole"),
            T.short_preview(F.lit("ab")).alias("always"),
            T.plain_text(F.lit("<p>Hi <!-- no --><b>you</b>&amp;</p><script>x()</script>")).alias("plain"),
            T.is_blank(F.lit(" \t")).alias("blank"),
            T.token_cover(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit("a"))).alias("cover"),
        )
        .first()
    )
    assert row.terms == ["err", "42", "caf"]
    assert row.key == "ba7816bf8f01cfea"
    assert row.short == "a b"
    assert row.cut == "x" * 157 + "..."
    assert row.whole == "x" * 160
    assert row.always == "ab..."
    assert row.plain == "Hi you"
    assert row.blank is True
    assert row.cover == 0.5
