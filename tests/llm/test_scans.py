"""Secrets and personal data against plain Python, whole tables and planted edge cases."""

import collections
import random
import string
import time

import pytest

from audience_engine.llm import pii, queries, secrets
from audience_engine.llm.spans import apart_from

from . import brute

SF = "/root/testdata/sf0.001"
EDGES = [
    None, "", "x", "token=secret: abcdefgh1", "PassWord : 'abcdefgh' pässwd=12345678", "é token = \"abcdef12345\" AKIAABCDEFGHIJKL AKIA1",
    "0123456789abcdef0123456789abcdef x 0123456789abcdef", "a@b.c_d@e.f 1.2.3.4 256.1.1.1 01.002.3.4.5 1.2.3.99999999999999999999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (456) 555-2186. +49 1 +1234567890123456", "1" * 9000, "ab@" * 3000, "\U0001F600 a@b.co \U0001F600 10.0.0.1",
    "api_key=" + "A" * 20000, "token: " * 500, "mail me: bob at example dot com or 555-123-4567, DE89370400440532013000",
]


def frame(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, s string, n int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_secret_edges(spark):
    got = by_id(secrets.digest(secrets.find_secrets(frame(spark, EDGES))))
    for i, t in enumerate(EDGES):
        want = brute.secret_spans(t or "")
        assert got[i]["base_sha256"] == brute.sha(want), t
        base = [x for x in got[i]["spans"].split(",") if x and not x.startswith("random")]
        assert base == want
        assert got[i]["n_assign"] + got[i]["n_access"] + got[i]["n_hex"] == len(want)


def test_pii_edges(spark):
    got = by_id(pii.digest(pii.find_pii(frame(spark, EDGES))))
    for i, t in enumerate(EDGES):
        want = brute.pii_spans(t or "")
        assert got[i]["base_sha256"] == brute.sha(want), t
        assert got[i]["spans"].split(",")[: len(want)] == (want or got[i]["spans"].split(",")[:0])


@pytest.mark.parametrize("name,rule", [("op8_secrets", brute.secret_spans), ("op9_pii", brute.pii_spans)])
def test_queries_on_whole_tables(spark, name, rule):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = by_id(queries.QUERIES[name](spark, SF))
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert got[i]["base_sha256"] == brute.sha(rule(t or ""))


def test_markov_models_tell_random_from_ordinary(spark):
    plain = ["the and someOrdinary identifier_names everywhere internationalization configuration", "words_of_the_language naturally"] * 20
    draw = random.Random(7)
    marked = ["password=" + "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(24)) for _ in range(60)]
    docs = frame(spark, plain + marked + ["here Xq7Rt2Lm9Vb4Kz81Wp0 and internationalizationconfiguration"])
    last = len(plain) + len(marked)
    found = {r["doc_id"]: r for r in secrets.find_secrets(docs).collect()}
    assert [x["m"] for x in found[last]["random"]] == ["Xq7Rt2Lm9Vb4Kz81Wp0"]
    assert all(not found[i]["random"] for i in range(len(plain)))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(secrets.find_secrets(docs)).collect()}
    assert clean[last] == "here [secret] and internationalizationconfiguration"
    assert clean[len(plain)] == "[secret]"


def test_random_strings_in_a_whole_table_and_nothing_else(spark):
    """Planted strings of several alphabets are found; numbers, words and the rest of the table are left alone."""
    own = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    draw = random.Random(11)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits]
    planted = {10_000_000 + i: "".join(draw.choice(alphabets[i % 3]) for _ in range(20 + i % 20)) for i in range(90)}
    texts = {i: f"some words before {k} and after" for i, k in planted.items()}
    texts |= {20_000_000 + i: "number " + "".join(draw.choice(string.digits) for _ in range(16 + i % 8)) + " here" for i in range(90)}
    found = secrets.find_secrets(own.union(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))).where("size(random) > 0")
    got = {r["doc_id"]: [x["m"] for x in r["random"]] for r in found.select("doc_id", "random").collect()}
    assert sum(got.get(i) == [k] for i, k in planted.items()) >= 88
    assert set(got) <= set(planted)  # no number, no word of the table


def test_planted_personal_data_and_clean_prose(spark):
    own = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = {1: ("contact", "please mail bob at example dot com today", "bob at example dot com"), 2: ("contact", "write to ann.b [at] mail [dot] example [dot] org now", "ann.b [at] mail [dot] example [dot] org"),
            3: ("contact", "reach me: joe @ example.net soon", "joe @ example.net"), 4: ("number", "call (212) 555-0199 tonight", "(212) 555-0199"),
            5: ("number", "my phone: 646-555-0123 or mail", "646-555-0123"), 6: ("account", "pay to IBAN DE89370400440532013000 please", "DE89370400440532013000")}
    clean = ["he looked at example.com today", "we met at noon. Then the rain came", "order 100 200 3000 of them", "released 2019-2020-2021 at the dot", "version 800.555.1234.17 is out",
             "the number 4785380592391139 is long", "AB12XYZXYZXYZXYZ is a part"]
    texts = [(10_000_000 + k, t) for k, (_, t, _) in more.items()] + [(20_000_000 + i, t) for i, t in enumerate(clean)]
    found = pii.find_pii(own.union(spark.createDataFrame(texts, "doc_id long, text string"))).where("size(contact) + size(number) + size(account) > 0")
    got = {r["doc_id"]: [(k, x["m"]) for k in pii.ADDED for x in r[k]] for r in found.collect()}
    assert got == {10_000_000 + k: [(kind, m)] for k, (kind, _, m) in more.items()}


def test_overlaps_by_binary_search(spark):
    draw = random.Random(3)

    def spans(n):
        cuts = sorted(draw.sample(range(400), 2 * n))
        return list(zip(cuts[::2], cuts[1::2], strict=True))

    rows = [(i, spans(draw.randint(0, 40)), spans(draw.randint(0, 40)), spans(draw.randint(0, 40))) for i in range(60)]
    kind = "array<struct<s:int,e:int>>"
    df = spark.createDataFrame(rows, f"i int, c {kind}, a {kind}, b {kind}")
    for r in df.select("*", apart_from(df["c"], "a", "b").alias("left")).collect():
        assert [tuple(x) for x in r["left"]] == [tuple(c) for c in r["c"] if not any(o["s"] < c["e"] and c["s"] < o["e"] for o in r["a"] + r["b"])]


def test_runs_of_a_million_characters(spark):
    """A failing start is not tried again at each character of its run."""
    n = 1_000_000
    texts = ["x" * n + " a@b.co", "1" * n + " 1.2.3.4", "aB3+" * (n // 4) + " a@b.co", "a." * (n // 2) + " at b dot com", "+1" + " " * n, "token" + " " * n, "a@b.co 555-123-4567 " * (n // 40)]
    df = frame(spark, texts)
    start = time.monotonic()
    got = by_id(pii.digest(pii.find_pii(df)))
    assert [got[i]["n_email"] for i in range(4)] == [1, 0, 1, 0]
    assert got[1]["n_ip"] == 1 and got[6]["n_email"] == n // 40
    secrets.digest(secrets.find_secrets(df)).count()
    assert time.monotonic() - start < 60


def test_labelers_reliability_is_recovered(spark):
    """Votes drawn with known reliabilities: expectation-maximisation finds them and the shares by group."""
    draw, rates, shares = random.Random(5), [(0.9, 0.1), (0.85, 0.3), (0.7, 0.05), (0.8, 0.2), (0.95, 0.4)], {0: 0.9, 1: 0.3, 2: 0.5}
    patterns = collections.Counter()
    for g, share in shares.items():
        for _ in range(20_000):
            real = draw.random() < share
            code = g
            for yes, no in rates:
                code = code * 3 + (0 if draw.random() < 0.2 else 1 + (draw.random() < (yes if real else no)))
            patterns[code] += 1
    _, got, found = pii.reliabilities(dict(patterns), rounds=200)
    for (yes, no), (y, n) in zip(rates, got, strict=True):
        assert abs(yes - y) < 0.05 and abs(no - n) < 0.05
    assert all(abs(found[g] - s) < 0.05 for g, s in shares.items())


def test_iban(spark):
    rows = [("DE89370400440532013000", True), ("GB82WEST12345698765432", True), ("GB82WEST12345698765431", False), ("FR1420041010050500013M02606", True)]
    df = spark.createDataFrame(rows, "a string, ok boolean")
    assert all(r["got"] == r["ok"] for r in df.select("ok", pii.iban(df["a"]).alias("got")).collect())


def test_null_and_repeated_ids(spark):
    rows = [(None, "a@b.co token: abcdefgh1"), (None, None), (3, "x@y.org"), (3, "x@y.org"), (3, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_email"]) for r in pii.digest(pii.find_pii(df)).collect())
    assert got == [(0, 0), (0, 1), (3, 0), (3, 1), (3, 1)]
    assert sorted(r["n_assign"] for r in secrets.digest(secrets.find_secrets(df)).collect()) == [0, 0, 0, 0, 1]


def test_labelers_and_mask(spark):
    belief, rates, _ = pii.reliabilities({0: 50, int("22211", 3): 40, int("20110", 3): 10})
    assert belief[int("22211", 3)] > 0.9
    assert all(0 < y < 1 and 0 < n < 1 for y, n in rates)
    masked = {r["doc_id"]: r["text"] for r in pii.mask(pii.find_pii(frame(spark, ["x a@b.co y", None, "no"]))).collect()}
    assert masked == {0: "x [email] y", 1: "", 2: "no"}


def test_empty_tables(spark):
    none = frame(spark, ["x"]).where("doc_id < 0")
    assert secrets.digest(secrets.find_secrets(none)).count() == 0
    assert pii.digest(pii.find_pii(none)).count() == 0
