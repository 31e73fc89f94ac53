import hashlib
import random
import re

from pyspark.sql import functions as F

from linkrec.llm.pii import FINDERS, KINDS, find_all, luhn, personal_data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(kind, t):
    out = []
    for m in re.finditer(PLAIN[kind], t):
        digits = re.sub("[^0-9]", "", m[0])
        ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
              "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
        if ok:
            out.append(m.span())
    return out


def test_base_finders_match_plain_regex():
    rng = random.Random(5)
    alphabet = ["a", "b.c", "@", ".", "..", "-", "+", "%", "_", "1", "255", "256", "12.3", " ", "(", ")", "é",
                "4111 1111 1111 1111", "+1 (017) 555-7713", "x@y.z", "10.0.0.1", "\n", "@b.c@d.e", "_d@e.f"]
    for _ in range(4000):
        t = "".join(rng.choices(alphabet, k=rng.randrange(1, 14)))
        for k in KINDS:
            assert FINDERS[k](t) == brute(k, t), (k, t)


def added(t):
    return {(k, t[s:e]) for k, v in find_all(t)[1].items() for s, e in v}


def test_disguises_map_back_to_source():
    assert added("write to john.doe [at] example [dot] com now") == {("email", "john.doe [at] example [dot] com")}
    assert added("mail jane (at) mail.example.org!") == {("email", "jane (at) mail.example.org")}
    assert added("ask bob at example dot com today") == {("email", "bob at example dot com")}
    assert added("bob @ example.com") == {("email", "bob @ example.com")}
    assert added("see jоhn@exаmple.com ok") >= {("email", "jоhn@exаmple.com")} or \
        find_all("see jоhn@exаmple.com ok")[0]["email"]
    assert added("call +１ (２１２) ５５５-０１２３ now") == {("phone", "+１ (２１２) ５５５-０１２３")}
    assert added("ip 10​.0.0​.7 x") == {("ip", "10​.0.0​.7")}
    assert added("card four one one one one one one one one one one one one one one one.") == {
        ("card", "four one one one one one one one one one one one one one one one")}
    assert added("dial plus one two one two five five five zero one two three ok") == {
        ("phone", "plus one two one two five five five zero one two three")}


def test_each_disguise_alone():
    phone = ["+four 1 five 5 five 5 zero 1 two 3", "plus one dash five dash five dash five dash zero dash one dash two dash three dash four",
             "+1 (two) 2 5 5 5 0 1 2 3", "+1 212 five 55 0123", "+1212 five 550123"]
    for x in phone:
        assert added(f"call {x}; now") == {("phone", x)}, x
    for x in ("jane.doe at host.org", "name at host.org", "jane [at] host.org", "jane@host dot org", "jane @ host.org",
              "jane at host dot org", "jane@host (dot) org"):
        assert added(f"please: {x} now") == {("email", x)}, x
    assert added("ip 10.0.0 dot seven") == {("ip", "10.0.0 dot seven")}
    assert added("card 4111 1111 1111 111 one.") == {("card", "4111 1111 1111 111 one")}
    for x in ("Look at example.com or it is available at example.org.", "We met at 10.30 with 2 or three men.", "one of 12 at 3.5 km"):
        assert not added(x), x


def test_clean_text_gains_nothing():
    for t in ("Meet me at noon. The dot on the map is at one of two places.", "one two three four", "a @ b", "",
              "The price at the shop was 3.50 at two or three stores, at least.", "Москва 12.5 и 13", None):
        assert not any(find_all(t)[1].values()), t


def test_query_rows(spark):
    rows = [(1, "a@b.co and 1.2.3.4"), (1, "a@b.co and 1.2.3.4"), (2, None), (None, "x" * 400000 + " q@r.st"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = personal_data(df).collect()
    first = [r for r in got if r.doc_id == 1]
    assert len(first) == 2 and first[0] == first[1] and first[0].spans == "email:0:6,ip:11:18"
    assert first[0].base_sha256 == hashlib.sha256(b"email:0:6,ip:11:18").hexdigest()
    assert [r.n_email for r in got if r.doc_id is None] == [1]
    assert {r.base_sha256 for r in got if r.doc_id in (2, 3)} == {hashlib.sha256(b"").hexdigest()}
    assert personal_data(df.limit(0)).count() == 0
