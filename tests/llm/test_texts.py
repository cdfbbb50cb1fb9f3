import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankloom.llm import kneser_ney, language, near_duplicates, packing, pieces, pii, toxicity, training_order

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def ids_of(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())


def own_ids(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)]


# ----------------------------------------------------------------- pseudonyms
def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_format_and_stay_linked(spark):
    card = "4111 1111 1111 1111"
    texts = [f"pay {card} or {card.replace(' ', '')}", "bad 4111111111111112", "on 2024-02-29, 29.02.2024, 31.02.2024",
             "a.b@mail.example.com +1 (456) 555-2186 10.0.0.255 300.1.1.1 123-45-6789", "DE89370400440532013000", "v2.0 nothing"]
    rows = [r.text for r in pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    first, second = re.findall(r"4\d{3} \d{4} \d{4} \d{4}|4\d{15}", rows[0])
    assert first.replace(" ", "") == second and luhn(second) and second != "4" + "1" * 15
    assert rows[1] == texts[1] and rows[5] == texts[5]
    iso, dotted, bad = re.search(r"on (\S+), (\S+), (\S+)", rows[2]).groups()
    assert iso.split("-") == dotted.split(".")[::-1] and iso != "2024-02-29" and bad == "31.02.2024"
    mail, a, b, ip, odd, social = re.fullmatch(r"(\S+) \+1 \((\d{3})\) (\d{3}-\d{4}) (\S+) (\S+) (\S+)", rows[3]).groups()
    assert re.fullmatch(r"[a-z]\.[a-z]@mail\.example\.com", mail) and a[0] in "23456789" and b[0] in "23456789"
    assert all(int(p) < 256 for p in ip.split(".")) and odd == "300.1.1.1" and social != "123-45-6789"
    digits = rows[4][4:] + "".join(str(ord(c) - 55) for c in rows[4][:2]) + rows[4][2:4]
    assert int(digits) % 97 == 1 and rows[4] != texts[4]


def test_permutations_are_one_to_one(spark):
    pairs = spark.range(15).crossJoin(spark.range(7).withColumnRenamed("id", "y")).select(pii.permuted(F.col("id"), F.col("y"), 15, 7, "k", "t").alias("p"))
    found = {(r.p.x, r.p.y) for r in pairs.collect()}
    assert found == {(x, y) for x in range(15) for y in range(7)}
    names = spark.createDataFrame([(f"{a}{b}{c}",) for a in "abcz" for b in "0159" for c in "AZ"], "v string")
    assert names.select(pii.shuffled(F.col("v"), "k", "t")).distinct().count() == 32


def test_pseudonyms_of_odd_rows(odd, ids):
    found = pii.pseudonymised(odd)
    assert found.columns == odd.columns and ids_of(found) == ids
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert pii.pseudonymised(odd.limit(0)).count() == 0


# -------------------------------------------------------------------- packing
def test_packing_holds_every_token_once(odd):
    rows = odd.collect()
    got = packing.pack(odd, WORDS, window=64).collect()
    want = {}
    for r, tokens in zip(rows, own_ids([r.text for r in rows])):
        want.setdefault(r.doc_id, []).append(tokens + [1])
    by_doc = {}
    for p in got:
        by_doc.setdefault((p.doc_id, p.sequence_id * 64 + p.offset - p.start), []).append(p)
    assert len(by_doc) == len(rows)
    for (doc, _), found in by_doc.items():
        found.sort(key=lambda p: p.start)
        tokens = next(t for t in want[doc] if len(t) == found[0].doc_tokens)
        at = 0
        for p in found:
            part = tokens[p.start : p.start + p.length]
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p.length
        assert at == len(tokens)
    spans = sorted((p.sequence_id * 64 + p.offset, p.length) for p in got)
    assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]
    assert all(p.offset + p.length <= 64 for p in got)
    assert packing.pack(odd.limit(0), WORDS).count() == 0


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    alphabet = "ab.,'s_ É\nßİΣ1½\t\x85<|>́A"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)] + ["<|ENDOFTEXT|>. x", "it's. a.. b"]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(WORDS, "<u4").encode(texts)] == own_ids(texts)


def test_plain_words_reach_the_model_directly(monkeypatch):
    encoder = packing.Encoder(WORDS, "<u4")
    low = [c for c in map(chr, range(256)) if c.isalpha() and c.islower()]
    words = low + [a + b for a in low for b in low] + ["onoulyan", "\xe9treon", "stra\xdfe", "\xaa\xba"]
    want = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]

    class Refuses:
        def encode_batch_fast(self, texts, **_):
            assert texts == []
            return []

    monkeypatch.setattr(encoder, "tokenizer", Refuses())
    encoder.learn(words)
    assert [np.frombuffer(encoder.known[w], "<u4").tolist() for w in words] == want


@pytest.mark.parametrize("text", ["a.. b", "a., b", "a_, b", "a, b", "a. ", "., ", ". a", "\xe9, b", "!. b", " , b", "a.b, c"])
def test_runs_of_marks_are_found(text):
    assert bool(packing._RUN_OF_MARKS.search(text)) == any(
        text[i + 1] in ".," and text[i + 2] == " " and not (text[i].isalnum() or text[i].isspace()) for i in range(len(text) - 2)
    )


# --------------------------------------------------------------- training order
@pytest.mark.parametrize("size", [1, 2, 5, 64, 1000])
def test_slots_are_a_permutation(size):
    found = training_order.slots(np.arange(size), size, 9)
    assert sorted(found) == list(range(size))
    assert (training_order.numbers(found, size, 9) == np.arange(size)).all()


def test_shards_hold_all_sequences_in_slot_order(odd, tmp_path):
    path, described, total = training_order.materialise(odd, WORDS, key=4, length=32, shard_rows=16, path=f"{tmp_path}/out")
    import glob

    stream, stride = {}, 65
    for name in glob.glob(f"{path}/shard=*/part-*"):
        shard = int(re.search(r"shard=(\d+)", name)[1])
        content = open(name, "rb").read()
        for i in range(len(content) // stride):
            stream[shard * 16 + i] = np.frombuffer(content[i * stride : (i + 1) * stride - 1], "<u2")
    assert sorted(stream) == list(range(total)) == sorted(r.slot for r in described.collect())
    by_number = sorted((r.sequence, r.slot, r.n_tokens) for r in described.collect())
    tokens = np.concatenate([stream[slot][:n] for _, slot, n in by_number]).tolist()
    assert sorted(tokens) == sorted(i for t in own_ids([r.text for r in odd.collect()]) for i in [*t, 1])
    got = {r.slot: r.ids_crc32 for r in training_order.digest(odd, WORDS, key=4, length=32, shard_rows=16).collect()}
    assert got == {slot: zlib.crc32(x.tobytes()) for slot, x in stream.items()}
    assert training_order.digest(odd.limit(0), WORDS).count() == 0


# ----------------------------------------------------------------------- pieces
def whole_search(vocabulary, text):
    """The best segmentation by a table over the whole text; ties to the longer last piece."""
    marked = pieces.SPACE + text.replace(" ", pieces.SPACE)
    best = [(0.0, 0, 0)]
    for end in range(1, len(marked) + 1):
        found = None
        for start in range(max(0, end - vocabulary.longest), end):
            piece = vocabulary.score.get(marked[start:end])
            if piece and (found is None or best[start][0] + piece[0] > found[0]):
                found = (best[start][0] + piece[0], start, piece[1])
        best.append(found or (best[end - 1][0] + vocabulary.worst, end - 1, vocabulary.unknown))
    out, end = [], len(marked)
    while end:
        _, start, piece = best[end]
        raw = marked[start:end].encode("utf-8", "surrogatepass")
        out += [vocabulary.bytes_at[b] for b in reversed(raw)] if piece == vocabulary.unknown else [piece]
        end = start
    return out[::-1]


def test_streaming_search_equals_whole_search_and_round_trips():
    vocabulary, rng = pieces.Pieces(PIECES), random.Random(5)
    texts = ["".join(rng.choice("theradn  é漢😀\n.") for _ in range(rng.randrange(1, 200))) for _ in range(200)] + ["", "a" * 3000]
    for text in texts:
        ids = np.frombuffer(vocabulary.encode(text), "<u4")
        assert ids.tolist() == (whole_search(vocabulary, text) if text else [])
        assert vocabulary.decode(ids) == text
        runs = list(vocabulary.stream(pieces.SPACE + text.replace(" ", pieces.SPACE))) if text else []
        assert [i for run in runs for i in run] == ids.tolist()


def test_pieces_of_odd_rows(odd, ids):
    found = pieces.digest(odd, PIECES)
    assert ids_of(found) == ids and all(r.round_trip for r in found.collect())
    back = {(r.doc_id, r.text) for r in pieces.decode(pieces.encode(odd, PIECES), PIECES).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd.collect()}


# -------------------------------------------------------------- near duplicates
def _bag(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    n = min(5, len(words))
    bag = {}
    for i in range(len(words) - n + 1 if words else 0):
        bag[tuple(words[i : i + n])] = bag.get(tuple(words[i : i + n]), 0) + 1
    return bag


def _similar(a, b):
    both = set(a) | set(b)
    return sum(min(a.get(x, 0), b.get(x, 0)) for x in both) / max(1, sum(max(a.get(x, 0), b.get(x, 0)) for x in both)) >= 0.8


def test_classes_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(3, 90))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 8])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() + ".")
    rng.shuffle(texts)
    bags, parent = [_bag(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if _similar(bags[i], bags[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()} == {i: root(i) for i in range(len(texts))}


def test_signatures_estimate_weighted_similarity():
    element, texts = np.arange(200, dtype=np.uint64), 2
    weight = np.concatenate([np.full(200, 1.5), np.full(100, 1.5), np.full(100, 0.5)])
    cut = near_duplicates.cells(np.repeat([0, 1], 200), np.tile(element, 2), weight)
    table = near_duplicates.signatures(*cut, texts)
    assert abs((table[0] == table[1]).mean() - 200 / 300) < 0.15


def test_classes_of_odd_rows(odd, ids):
    found = near_duplicates.classes(odd)
    assert ids_of(found) == ids
    assert {r.doc_id: r.class_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, None: None, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9}
    left = near_duplicates.one_of_each(odd)
    assert left.columns == odd.columns and ids_of(left) == sorted(x for x in set(ids) if x != (False, 2))
    assert near_duplicates.classes(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ classifiers
def _language_rows(n, seed=1):
    rng = random.Random(seed)
    heads = {"en": "the of and shall with", "fr": "été où leçon déjà très", "de": "über größe für straße mädchen"}
    return [(i, " ".join(rng.choice(heads[lang].split()) for _ in range(25)), lang) for i in range(n) for lang in [list(heads)[i % 3]]]


def test_language_on_held_out_documents(spark):
    docs = spark.createDataFrame(_language_rows(240), "doc_id long, text string, lang string")
    rows = language.identify(docs).collect()
    truth = {i: lang for i, _, lang in _language_rows(240)}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    network = language.Network(["a", "b", "c"], hidden=3)
    data, target = rng.integers(1, 256, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    real = np.ones(data.shape, bool)

    def loss():
        chances = network.label(data).astype(np.float64)
        return -np.log(chances[:, target, np.arange(4)]).mean()

    for weight, gradient in zip(network.weights(), network.learn(data, target, real)):
        for at in [np.unravel_index(i, weight.shape) for i in np.argsort(-np.abs(gradient).ravel())[:3]]:
            old = weight[at]
            weight[at] = old + 1e-2
            up = loss()
            weight[at] = old - 1e-2
            slope, weight[at] = (up - loss()) / 2e-2, old
            assert slope == pytest.approx(gradient[at], rel=0.1, abs=2e-4)


def test_model_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("abracadabra", True), ("banana band", True), ("xyz banana", False)], "text string, counted boolean")
    model = {r.g: np.exp(r.lp) for r in kneser_ney.log_probabilities(kneser_ney.gram_counts(docs)).collect()}
    key, _ = kneser_ney.grams(["abracadabra", "banana band", "xyz banana"])
    assert set(model) == set(key.tolist()) and all(0 < p < 1 for p in model.values())
    by_context = {}
    for g, p in model.items():
        by_context[g >> 12] = by_context.get(g >> 12, 0) + p
    assert all(total <= 1 + 1e-9 for total in by_context.values())
    table = kneser_ney.Lookup(np.array(list(model)), np.log(list(model.values())))
    assert np.allclose(table.get(key), [np.log(model[k]) for k in key.tolist()], rtol=1e-6)
    assert (table.get(np.array([1 << 59])) == 0).all()


def test_quality_rejects_strange_text(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice("the cat sat on a mat with his old hat".split()) for _ in range(40)) for _ in range(300)]
    bad = ["".join(rng.choice("#@QZ%&9X") for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(good + bad)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(305, 0, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in kneser_ney.good_documents(docs, labels).collect()}
    assert not kept & set(range(300, 320)) and len(kept) >= 297


def test_toxicity_finds_telling_words(spark):
    rng = random.Random(4)
    plain = "the cat sat on mat with old hat near mill".split()
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 4 == 0:
            words[5:7] = [f"vile{rng.randrange(50)}", rng.choice(["scum", "moron"])]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, "cat " * 20_000 + "scum moron " * 3)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i < 200], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.toxic for r in toxicity.judged(docs, labels).collect()}
    assert all(found[i] == bool(y) for i, _, y in rows) and found[1000]
    assert toxicity.clean_documents(docs, labels).count() == 300


def test_classifiers_on_odd_rows(odd, labels, ids):
    assert ids_of(language.identify(odd)) == ids
    assert {r.doc_id: r.lang_pred for r in language.identify(odd).where("doc_id in (3, 4, 5, 9)").collect()} == {i: "und" for i in (3, 4, 5, 9)}
    assert ids_of(toxicity.judged(odd, labels)) == ids
    judged = kneser_ney.judged(odd, labels)
    assert judged.count() == len(ids) - 1  # equal rows once
    assert all(r.keep and r.perplexity is None for r in judged.where("doc_id in (3, 4)").collect())
    for kept in (toxicity.clean_documents(odd, labels), kneser_ney.good_documents(odd, labels)):
        assert kept.columns == odd.columns
    for nothing in (odd.limit(0), odd):
        assert toxicity.judged(nothing, labels.limit(0)).where("toxic").count() == 0
        assert kneser_ney.judged(nothing, labels.limit(0)).where("not keep").count() == 0
    assert language.identify(odd.limit(0)).count() == 0


# ------------------------------------------------------------------- repeated and hostile rows
@pytest.mark.parametrize("text", ["x a@b" + ".a" * 20_000, "a@" + "b" * 200_000, "1.1" * 50_000, "AB12 " + "ABCD " * 30_000, "1-" * 80_000, "token=" * 30_000])
def test_long_runs_of_one_pattern_end(spark, text):
    """Runs that once made the pattern engine call itself for each part."""
    found = pii.pseudonymised(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(found.text) == len(text)


def test_repeated_rows_are_judged_like_one(spark):
    rows = [(i, " ".join(f"word{(i * j) % 9}" for j in range(30)), "en") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    schema = "doc_id long, text string, lang string"
    once = {r.doc_id: r.perplexity for r in kneser_ney.judged(spark.createDataFrame(rows, schema), labels).collect()}
    again = [*rows, *[r for r in rows[:3] for _ in range(3)]]
    # the model sees more text, so perplexities move a little; they don't double with the copies
    for r in kneser_ney.judged(spark.createDataFrame(again, schema), labels).collect():
        assert r.perplexity == pytest.approx(once[r.doc_id], rel=0.25)


def test_texts_of_one_id_are_linked_apart(spark):
    """Near copies of either text of an id join its class, and so does a third text."""
    rng = random.Random(6)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    near = [t[:30] + ["other"] + t[31:] for t in texts]
    rows = [(1, " ".join(t)) for t in texts] + [(3 + i, " ".join(t)) for i, t in enumerate(near)] + [(9, "something else entirely, that nobody has")]
    found = near_duplicates.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == {1: 1, 3: 1, 4: 1, 5: 1, 9: 9}


@pytest.mark.parametrize("block", [7, 1000])
def test_dense_groups_of_near_copies_lose_no_link(spark, monkeypatch, block):
    """Many copies of one text, each changed in some places: some are similar to a few others only."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng, texts = random.Random(11), []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(60):
            copy = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    bags, parent = [_bag(t) for t in texts], list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(texts)):
        for j in range(i):
            if _similar(bags[i], bags[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()} == {i: root(i) for i in range(len(texts))}


def test_links_connect_what_is_similar_whatever_the_order():
    rng = np.random.default_rng(4)
    for _ in range(30):
        cells = [np.sort(rng.choice(40, rng.integers(0, 30), replace=False)).astype("<u4") for _ in range(12)]
        cells += [np.sort(np.append(rng.choice(c, max(len(c) - 1, 0), replace=False), 99)).astype("<u4") for c in cells]
        want, got = list(range(len(cells))), list(range(len(cells)))

        def join(of, a, b):
            of[:] = [of[a] if x == of[b] else x for x in of]

        for a in range(len(cells)):
            for b in range(a):
                if near_duplicates.similarity(cells[a], cells[b]) >= near_duplicates.SIMILAR:
                    join(want, a, b)
        links = near_duplicates.linked(cells)
        for a, b in links:
            assert got[a] != got[b] and near_duplicates.similarity(cells[a], cells[b]) >= near_duplicates.SIMILAR
            join(got, a, b)
        assert len({*zip(want, got)}) == len(set(want)) == len(set(got))
