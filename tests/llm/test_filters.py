"""Line dedup, decontamination, licence scans and toxicity against brute force and edge cases."""

import hashlib
import random
import time

from pyspark.sql import functions as F

from linkrec.llm import decontam
from linkrec.llm.decontam import clean, contaminated
from linkrec.llm.licenses import TEMPLATES, scan_licenses
from linkrec.llm.line_dedup import line_report
from linkrec.llm.toxicity import NEAR, Tokens, Trie, features, fit, plain, score, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(2)
    pool = [f"line number {i} of the pool" for i in range(30)] + ["  Line Number 3 of the pool\t", "short", "", "ÉTÉ à la plage", "été à la plage"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(0, 9)))) for i in range(60)] + [(70, None), (71, "")]
    ws = " \t\n\x0b\x0c\r"
    low = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    key = lambda x: "".join(low.get(c, c) for c in x.strip(ws))
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            owner[key(x)] = min(i, owner.get(key(x), i))
    want = {}
    for i, t in rows:
        ls = (t or "").split("\n")
        keep = [x for x in ls if len(key(x)) < 10 or owner[key(x)] == i]
        want[i] = (len(ls), len(ls) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest())
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_report(docs(spark, rows)).collect()}
    assert got == want
    twice = line_report(docs(spark, [(1, "the same line here"), (1, "the same line here"), (None, "the same line here")])).collect()
    assert sorted((r.doc_id or 9, r.n_dropped) for r in twice) == [(1, 0), (1, 0), (9, 1)]
    assert line_report(docs(spark, [])).count() == 0


def test_line_dedup_of_long_texts_is_linear(spark):
    text = "\n".join(f"line number {i} of a long text" for i in range(200_000))
    rows = [(1, text), (2, text), (3, text + "\nand one line of its own")]
    df = docs(spark, rows).selectExpr("*", "1 as owner", "'x' as row", "2 as pos", "3 as _gone", "4 as gone")
    start = time.time()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_report(df).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {1: (200_000, 0, hashlib.sha256(text.encode()).hexdigest()), 2: (200_000, 200_000, empty),
                   3: (200_001, 200_000, hashlib.sha256(b"and one line of its own").hexdigest())}
    assert time.time() - start < 90


def test_anchor_words_lose_no_document(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["Tom", "Anna", "km", "hours"]
    sentence = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + rng.choice([".", "?"])
    items = [(i, sentence(rng.randrange(1, 30)) + f" He has {i} coins.") for i in range(40)] + [(None, sentence(9)), (3, sentence(12))]
    texts = []
    for i in range(300):
        own, parts = [t for _, t in rng.choices(items, k=2)], [sentence(rng.randrange(0, 40)) for _ in range(3)]
        if i % 3:
            cut = own[0].split()
            own[0] = " ".join(cut[rng.randrange(0, 3):]).replace("coins", rng.choice(["coins", "stones"]))
            parts.insert(1, own[0] if i % 2 else own[0].lower())
        texts.append((i, " ".join(parts)))
    texts += [(900, items[0][1]), (901, "coins"), (902, None), (903, ""), (904, "1 2 3")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, texts)
    kept = decontam._candidates(df, bench, 5, 0.8)
    got = sorted(map(str, contaminated(df, bench).collect()))
    assert kept.count() < df.count() and len(got) > 50
    monkeypatch.setattr(decontam, "_candidates", lambda d, *a: d)
    assert sorted(map(str, contaminated(df, bench).collect())) == got
    assert decontam.anchors(df, spark.createDataFrame([(1, "12 13 14")], "item_id long, text string"), 5, 0.8) is None


def test_decontamination(spark):
    bench = spark.createDataFrame([
        (1, "A train with 12 coaches leaves Paris after 30 minutes and meets 12 other coaches near the old bridge."),
        (2, "Completely different question about rivers and mountains in the far north of the country."),
        (3, None)], "item_id long, text string").withColumn("row", F.lit(1))
    same = "Intro text here. A train with 12 coaches leaves Paris after 30 minutes and meets 12 other coaches near the old bridge. More."
    rows = [(1, same), (2, same.replace("12", "99").replace("30", "7")),
            (3, same.replace("12 coaches", "1 coaches").replace("12 other", "2 other").replace("30", "4")),
            (4, "Nothing to see, just words about trains and bridges and coaches."), (5, None), (6, ""), (None, same),
            (1, "another text of the same id"), (7, "w " * 100000)]
    df = docs(spark, rows).withColumn("item_id", F.lit(5))
    got = {(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()}
    assert {(1, 1), (2, 1), (None, 1)} <= got and not {d for d, _ in got} & {4, 5, 6, 7}
    left = clean(df, bench)
    assert left.columns == df.columns
    assert {r.text for r in left.collect() if r.doc_id == 1} == {"another text of the same id"}
    assert contaminated(df.limit(0), bench).count() == 0 and contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_judges_each_occurrence(spark):
    a = "Please say what the capital city of France is and name two rivers that run through it today."
    b = a.replace("France", "Spain")
    sum_ = "Then Tom buys 14 apples and 3 pears, and later Tom gives 3 pears and 5 of the 14 apples to his sister."
    other = sum_.replace("14", "21").replace("3", "8").replace("5", "2")
    bench = spark.createDataFrame([(1, a), (2, b), (3, sum_)], "item_id long, text string")
    drift = sum_.replace("and later", "and then a good deal later")
    mixed = sum_.replace("gives 3", "gives 9").replace("the 14", "the 77")      # values that do not fit
    rows = [(1, a + " " + b), (2, sum_ + " " + other), (3, " ".join([other, "Some words between them.", sum_, other])),
            (4, a), (5, "\n".join(a.replace("France", x) for x in ("Italy", "Norway", "Peru", "Spain"))),
            (6, other + " " + drift), (7, mixed), (8, mixed.replace("14", "1") + " " + mixed)]
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(spark, rows), bench).collect()}
    assert got == {(i, k) for i in (1, 4, 5) for k in (1, 2)} | {(2, 3), (3, 3), (6, 3)}
    assert {r.doc_id for r in clean(docs(spark, rows), bench).collect()} == {7, 8}


def test_decontamination_reads_names_in_any_case(spark):
    one = "Tom has 12 apples and gives Mary 4 of them. Mary eats 2 at once. Tom then asks Mary how many are left, and Mary tells Tom."
    two = "Which river does the old stone bridge near the castle of Prague cross on its way?"
    bench = spark.createDataFrame([(1, one), (2, two), (3, "Vltava or Moldau river?")], "item_id long, text string")
    new = one.replace("Tom", "Anna").replace("Mary", "Peter")
    rows = [(1, f"some words {one.lower()} more"), (2, f"SOME WORDS {one.upper()} MORE"), (3, f"Some words. {new} More."),
            (4, two.lower()), (5, two.upper()), (6, "we crossed the vltava or moldau river at night and slept well"),
            (7, "we crossed the river moldau or the vltava at night")]
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3)}


def test_licenses(spark):
    rows = [(1, "foo\n\nReleased under the MIT license!\n\nbar"), (2, TEMPLATES["MIT"].replace(" to ", " to\n")),
            (3, "license of the mit"), (4, None), (5, ""), (6, "All rights reserved.\n\nALL RIGHTS RESERVED")]
    got = {(r.doc_id, r.license): (r.n_units, r.dice) for r in scan_licenses(docs(spark, rows)).collect()}
    assert got[(1, "MIT-notice")] == (1, 1.0) and (2, "MIT") in got and got[(6, "all-rights-reserved")] == (2, 1.0)
    assert not {d for d, _ in got} & {3, 4, 5}
    assert scan_licenses(docs(spark, [])).count() == 0


def test_automaton_and_context():
    trie = Trie(["idiot", "moron", "scum"], ["motion"])
    assert trie.match("idiot") == ("idiot", 0) and trie.match("idjot") == ("idiot", 1) and trie.match("idiott") == ("idiot", 1)
    assert trie.match("scam") is None and trie.match("oron") is None and trie.match("motion") is None
    assert plain("1d10t!!") == "idiot" and plain("$$$") == ""
    assert features("you idiot", Tokens(trie))[4] > 0 and features("he said \"idiot\"", Tokens(trie))[3] > 0
    assert not features(None, Tokens(trie)).any() and not features("fine words", Tokens(trie)).any()


def test_automaton_against_brute_force():
    def distance(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]
    terms = ["idiot", "moron", "scum", "zqx", "blorgous", "imbecilic", "aabbaabb", "abab"]
    trie = Trie(terms, ["slum"], **NEAR)
    assert [trie.match(w) for w in ("jdiot", "diot", "idoit", "xmoron", "scam", "imebcilci", "zqy", "slum")] == [
        ("idiot", 1), ("idiot", 1), ("idiot", 1), ("moron", 1), ("scum", 1), ("imbecilic", 2), None, None]
    rng = random.Random(9)
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randrange(3)] = rng.choices("abcdiotmx", k=rng.randrange(3)) if rng.random() < 0.6 else w[k:k + 2][::-1]
        w = "".join(w)
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= (2 if len(t) >= 8 else 1 if len(t) >= 4 else 0)]
        assert trie.match(w) == (min(near)[::-1] if near and w != "slum" else None), w


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(1)
    words = [f"word{i}x" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        rows.append((i, " ".join(rng.choices(words, k=20) + (["blorgous"] * 2 if bad else [])).replace("word", "plain")))
        labels.append((i, 1, int(bad)))
    rows += [(900, None), (901, ""), (902, "such a blorgus thing"), (None, "blorgous")]
    df = docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity(df, lab).collect()}
    assert all(got[i].predicted == int(i % 5 == 0) for i in range(600) if got[i].held_out)
    assert sum(got[i].held_out for i in range(600)) > 60
    assert got[900].predicted == got[901].predicted == 0 and got[902].score > got[901].score and got[None].predicted == 1
    blank = fit(df, lab.limit(0))
    assert score(df.limit(0), blank).count() == 0


def test_toxicity_learns_a_long_tail(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    terms = ["zqx"] + ["".join(rng.choices(letters, k=rng.randrange(8, 13))) for _ in range(99)]
    words = ["".join(rng.choices(letters[:12], k=6)) for _ in range(400)]
    share = [0.02] + [rng.uniform(0.012, 0.03) for _ in terms[1:]]
    rows, labels = [], []
    for i in range(6000):
        held = [t for t, p in zip(terms, share) if rng.random() < p] or [rng.choice(terms)]
        rows.append((i, " ".join(rng.sample([*rng.choices(words, k=25), *(held if i % 4 == 0 else [])], k=25))))
        labels.append((i, 1, int(i % 4 == 0)))
    df, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    copies = " ".join(f"unhappy{k}word" for k in range(200))
    extra = [(10_000 + i, copies.replace(f"unhappy{i}word", "other")) for i in range(40)]
    df = df.union(docs(spark, extra))
    lab = lab.union(spark.createDataFrame([(i, 1, 1) for i, _ in extra], lab.schema))
    model = fit(df, lab)
    assert not any(t.startswith("unhappy") for t in model["terms"])
    assert not set(model["terms"]) & set(words) and len(set(model["terms"]) & set(terms)) >= 95 and "zqx" in model["terms"]
    got = score(docs(spark, [(i, f"well {t} indeed") for i, t in enumerate(model["terms"])] + [(900, "well now indeed")]), model)
    assert {r.doc_id for r in got.collect() if r.score < 0.5} == {900}


def test_near_copies_are_one_piece_of_evidence(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("bcdfgklmnprstvz", k=3)) + "a" + "".join(rng.choices("bcdfg", k=3))
    base = [word() for _ in range(150)]
    copies = []
    for _ in range(60):                                      # toxic copies of one text, each with some words changed
        own = list(base)
        for k in rng.sample(range(150), 4):
            own[k] = word()
        copies.append(" ".join(own) + " you clown")
    prose = [word() for _ in range(300)]
    clean_texts = [" ".join(rng.choices(prose, k=40)) for _ in range(300)]
    toxic_texts = [" ".join([*rng.choices(prose, k=20), "you", rng.choice(["clown", "moron"]), *rng.choices(prose, k=20)]) for _ in range(80)]
    texts = [(t, 1) for t in copies + toxic_texts] + [(t, 0) for t in clean_texts]
    table = docs(spark, [(i, t) for i, (t, _) in enumerate(texts)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    assert fit(table, labels)["terms"] == ["clown", "moron"]
