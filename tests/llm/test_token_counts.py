import random

from pyspark.sql import functions as F

from linkrec.llm.token_counts import CountedText, cuts, load_encoder, redactions, token_counts

PIECES = ["foo", "bar ", " the", "it's", "\n", "  ", "42", "é", "ñandú", " ", ".", "!!", "a b c d e f ", "x" * 30]


def test_edits_equal_full_encoding():
    encoder = load_encoder()

    def count(parts):
        return [len(encoder.encode_ordinary(p)) for p in parts]
    rng = random.Random(4)
    for _ in range(150):
        text = "".join(rng.choices(PIECES, k=rng.randrange(0, 500)))
        doc = CountedText(text, count)
        assert doc.tokens == len(encoder.encode_ordinary(text))
        at, edits = 0, []
        while at < len(text) and len(edits) < 5:
            s = rng.randrange(at, len(text) + 1)
            e = min(len(text), s + rng.choice([0, 1, 3, 40]))
            edits.append((s, e, rng.choice(["", "new words", " ", "'s"])))
            at = e + 1
        new, last = [], 0
        for s, e, r in edits:
            new += [text[last:s], r]
            last = e
        whole = "".join([*new, text[last:]])
        n, encoded = doc.edit(edits)
        assert n == len(encoder.encode_ordinary(whole))
        if len(text) > 6000 and len(edits) == 1:
            assert encoded < len(text) / 2
    long = "one two three " * 5000
    doc = CountedText(long, count)
    n, encoded = doc.edit([(30000, 30003, "seven")])
    assert n == len(encoder.encode_ordinary(long[:30000] + "seven" + long[30003:])) and encoded < 2000
    assert len(cuts(long)) > 100


def test_rows(spark):
    rows = [(1, "call 0123456789 now"), (2, None), (3, ""), (None, "x"), (1, "call 0123456789 now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: r for r in token_counts(df).collect()}
    enc = load_encoder()
    assert got[1].n_tokens == len(enc.encode_ordinary("call 0123456789 now")) and got[1].n_edits == 1
    assert got[1].n_tokens_edited == len(enc.encode_ordinary("call [redacted] now"))
    assert got[2].n_tokens == got[3].n_tokens == 0 and redactions(None) == []
    assert token_counts(df.limit(0)).count() == 0


def test_batches_of_edits_follow_one_another():
    import random
    from linkrec.llm.token_counts import CountedText, VOCABULARY, build, load_encoder
    encoder = load_encoder(VOCABULARY)
    sizes = []

    def count(parts):
        sizes.append(sum(map(len, parts)))
        return [len(encoder.encode_ordinary(p)) for p in parts]

    r = random.Random(11)
    words = ["alpha", "Beta's", "12", "don't", "été", "x", "  ", "\n", "日本", "end.", "a b c"]
    for length in (0, 3, 400, 3000):
        text = " ".join(r.choice(words) for _ in range(length))
        doc = CountedText(text, count)
        for _ in range(12):
            places = sorted(r.sample(range(len(text) + 1), min(6, (len(text) + 1) // 2 * 2)))
            edits = [(s, e, r.choice(["", "new words here", " ", "Z", "word " * 300]))
                     for s, e in zip(places[::2], places[1::2])] or [(0, 0, "first words")]
            for s, e, new in reversed(edits):
                text = text[:s] + new + text[e:]
            del sizes[:]
            tokens, encoded = doc.edit(edits)
            assert doc.text == text and tokens == doc.tokens == len(encoder.encode_ordinary(text))
            assert sum(sizes) == encoded
            leaves = len(doc.tree) // 2
            assert doc.tree == build(doc.tree[leaves:leaves + max(len(doc.starts), 0)])
            assert doc.starts == sorted(set(doc.starts)) and (not text or doc.starts[0] == 0)
        assert doc.edit([(0, len(text), "")])[0] == 0 and doc.text == "" and doc.starts == []
        assert doc.edit([(0, 0, "again here")])[0] == len(encoder.encode_ordinary("again here"))
