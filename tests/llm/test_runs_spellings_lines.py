"""Periodic runs, spelling variants and repeated lines against brute force, with edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from audience_engine.llm import line_dedup, periodic, queries, spelling

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "a", 1, "b") for i, t in rows], "doc_id long, text string, word string, n int, key string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs --------------------------------------------------------------------

def runs_brute(w, min_length=6, exponent=4):
    """Every maximal stretch of every period; a stretch counts for its least period only."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            least = all(any(w[x] != w[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(min_length, exponent * q) and least:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    best = tuple(best[0]) + (1000 * best[0][1] // best[0][2],) if best else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_equal_brute_force_on_random_words():
    draw = random.Random(11)
    for case in range(1500):
        letters = draw.choice([1, 2, 3, 6])
        w = [draw.randrange(letters) for _ in range(draw.randrange(60))]
        for _ in range(draw.randrange(4)):  # repeated stretches, some inside others
            if w:
                a = draw.randrange(len(w))
                part = w[a:a + draw.randrange(1, 9)]
                w[a:a] = part * draw.randrange(1, 8)
        assert periodic.find_runs(w) == runs_brute(w), w
    for w in ("ab" * 9 + "c" + "ab" * 9, "aab" * 5 + "aaaaaaa", "abaab" * 8 + "abaabaab" * 5, "a" * 5, "a" * 6, "ab" * 4, "ab" * 4 + "a", "abc" * 4):
        assert periodic.find_runs(list(w)) == runs_brute(w)


def test_other_thresholds():
    draw = random.Random(4)
    for _ in range(300):
        w = [draw.randrange(2) for _ in range(40)]
        for length, exponent in ((3, 3), (6, 3), (12, 5)):
            assert periodic.find_runs(w, length, exponent) == runs_brute(w, length, exponent)
    with pytest.raises(ValueError):
        periodic.find_runs([1], 4, 2)


def test_suffix_order_and_positions():
    draw = random.Random(2)
    for _ in range(100):
        w = [draw.randrange(3) for _ in range(draw.randrange(1, 40))]
        order, lcp = periodic.suffix_order(np.array(w))
        assert order.tolist() == sorted(range(len(w)), key=lambda i: w[i:])
        for (a, b), l in zip(zip(order, order[1:]), lcp):
            same = 0
            while max(a, b) + same < len(w) and w[a + same] == w[b + same]:
                same += 1
            assert same == l
    values = list(range(5000))
    draw.shuffle(values)
    s, seen = periodic.Positions(values[0]), [values[0]]
    for x in values[1:]:
        before, after = s.insert(x)
        if len(seen) < 800:
            assert before == max((y for y in seen if y < x), default=-1) and after == min((y for y in seen if y > x), default=-1)
            seen.append(x)
    assert list(s) == sorted(values) and len(s.blocks) > 1


def test_run_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 5), (5, "a " * 6), (6, "x " + "a b " * 7 + "a"), (7, "é É " * 4), (7, "é É " * 4), (None, "q " * 9),
            (9, "a b " * 8), (10, "w " * 60_000), (11, " ".join(f"v{i % 30_000}" for i in range(120_000)))]
    rows += [(i, " ".join(random.Random(i).choice("abc") for _ in range(120))) for i in range(100, 160)]
    got = collected(periodic.digest(periodic.periodic_runs(frame(spark, rows), plant_tails=True)))
    small = [r for r in rows if r[0] not in (10, 11)]
    assert [r for r in got if r[0] not in (10, 11)] == sorted((runs_row(*r) for r in small), key=str)
    # one word repeated, and a period of 30,000 words, each four times and more
    long = {r[0]: r for r in got if r[0] in (10, 11)}
    assert long[10][1:6] == (1, 0, 60_000, 1, 60_000_000) and long[10][7] == sha("w")
    assert long[11][1:6] == (1, 0, 120_000, 30_000, 4000)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in small if i)
    assert periodic.periodic_runs(frame(spark, rows).where("doc_id < 0")).count() == 0
    big = [(2**60 + 1, "a " * 8), (None, "b")]
    assert {r.doc_id for r in periodic.periodic_runs(frame(spark, big)).collect()} == {2**60 + 1, None}


def test_collapse_and_strongest():
    w = list("xabababab" + "aaaaaaa")
    runs = periodic.find_runs(w)
    assert runs == runs_brute(w) and "".join(periodic.collapse(w, runs)) == "xab"
    assert periodic.strongest(runs) == max(runs, key=lambda r: r[1] / r[2])
    assert periodic.strongest([(0, 8, 2), (9, 4, 1)]) == (0, 8, 2) and periodic.strongest([]) is None


def test_runs_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, " ".join((t or "").split()[:2000]) if len((t or "").split()) > 2000 else t) for i, t in rows]
    assert collected(periodic.digest(periodic.periodic_runs(frame(spark, rows), plant_tails=True))) == sorted((runs_row(*r) for r in rows), key=str)
    got = queries.QUERIES["op11_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.count() == len(rows) and got.where("n_runs > 0").count() > 0


# -- spelling variants ----------------------------------------------------------------

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_brute(rows):
    count = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def spellings_brute(words):
    """Near words through the words with one code point taken out, confirmed letter by letter."""
    bare = collections.defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            bare[x].add(w)
    near = collections.defaultdict(set)
    for group in bare.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def test_scan_finds_exactly_the_words_at_one_edit():
    draw = random.Random(8)
    for case in range(200):
        words = sorted({"".join(draw.choice("abz") for _ in range(draw.choice([0, 1, 3, 4, 5]))) for _ in range(40)})
        top = max(map(len, words))
        words = [w for w in words if len(w) in (top, top - 1)]
        first = np.zeros(len(words), dtype=bool)
        first[0] = True
        i, j = spelling.near_middles(words, np.full(len(words), top), first)
        want = sorted((a, b) for a, x in enumerate(words) for b, y in enumerate(words) if len(x) == top and one_edit(x, y))
        assert sorted(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("group,middle", [(4096, 32), (3, 32), (4096, 2), (1, 1)])
def test_frames_keep_every_pair_once(spark, group, middle):
    draw = random.Random(group + middle)
    words = {"".join(draw.choice("aabé") for _ in range(draw.randrange(5, 9))): draw.randrange(3, 60) for _ in range(700)}
    words |= {"prefixprefixprefix" + "".join(draw.choice("ab") for _ in range(6)): draw.randrange(3, 60) for _ in range(60)}
    words |= {"aaaaa": 3, "aaaaaa": 9, "aaaaaaa": 30, "\U0001F600abcd": 5, "abcd\U0001F600": 5, "abcd￿": 5, "x" * 500: 4, "x" * 499: 9, "x" * 250 + "y" + "x" * 249: 20}
    table = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in spelling.near_words(table, group, middle).collect()}
    want = {}
    for w in words:
        near = [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(x, w)]
        if near:
            best = min(near, key=lambda x: (-words[x], x))
            want[w] = (len(near), best, words[best])
    assert got == want


def test_spelling_edges(spark):
    rows = [(1, None), (2, ""), (3, "12 .."), (4, "Hello hello HELLO hallo hallo hallo"), (5, "hello " * 9), (6, "hull× hull× hull×"), (7, "Élément " * 4),
            (8, "élément " * 8), (8, "élément " * 8), (None, "hallo helloo helloo helloo"), (9, "abcd " * 10), (10, "tie_aaaaa tie.aaaaa aaaab aaaab aaaab aaaac aaaac aaaac aaaaa"),
            (11, "chain " * 3 + "chaim " * 6 + "chalm " * 12 + "shalm " * 24 + "shala " * 48), (12, "z" * 3000 + " " + "z" * 3000 + " " + "z" * 3000)]
    rows += [(i, f"deletion{i % 3} deletions deletionss") for i in range(100, 500)]
    got = collected(spelling.group_spellings(frame(spark, rows)))
    assert got == spellings_brute(words_brute(rows))
    by = {r[0]: r for r in got}
    assert by["chain"][2] == "shala" and by["chain"][1] == "chaim" and by["hallo"][1] == "hello"
    assert any(len(w) == 8 and w not in ("deletion", "deletions") and w[:4] == "dele"[:4] for w in by) or "deletion" in by
    assert spelling.group_spellings(frame(spark, rows).where("doc_id < 0")).count() == 0
    assert spelling.group_spellings(frame(spark, [(1, "one two")])).count() == 0
    with pytest.raises(ValueError):
        spelling.group_spellings(frame(spark, rows), factor=1)


def test_spelling_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(queries.QUERIES["op12_spelling_variants"](spark, SF)) == spellings_brute(words_brute(rows))


# -- repeated lines -------------------------------------------------------------------

def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def lines_brute(rows, least=10, chars=1):
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[line_key(line)].add((i, t or ""))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(line_key(x)) < chars or len(held[line_key(x)]) < least]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def test_line_edges(spark):
    rows = [(i, f"own {i}\n Common LINE\t\n\nÉ accent\nown {i} end") for i in range(12)] + [(100, None), (101, ""), (102, "\n"), (103, "common line"), (104, "x\r\ncommon line\r\n"),
            (105, "é accent"), (106, "nine"), (None, "common line\nnull one"), (None, "common line\nnull two"), (107, "again\nagain"), (107, "again\nagain")]
    rows += [(200 + i, "nine\nten") for i in range(8)] + [(300, "ten"), (301, "ten\nten\nlast"), (302, " ten"), (303, "\x1cten"), (304, "common line\n" * 2000 + "tail")]
    rows += [(400, "same")] * 10 + [(500 + i, "same row ids") for i in range(3)] + [(600, f"text {i}\nshared by one id") for i in range(11)]
    got = collected(line_dedup.digest(line_dedup.drop_repeated_lines(frame(spark, rows))))
    assert got == lines_brute(rows)
    assert collected(line_dedup.digest(line_dedup.drop_repeated_lines(frame(spark, rows), 3, 5))) == lines_brute(rows, 3, 5)
    assert line_dedup.drop_repeated_lines(frame(spark, rows).where("doc_id < 0")).count() == 0


def test_long_texts_and_a_very_common_line(spark):
    rows = [(i, "licence\n" + f"line {i}") for i in range(3000)] + [(5000, "\n".join(f"l{i}" if i % 3 else "licence" for i in range(200_000))), (5001, " " * 300_000 + "x" + " " * 300_000)]
    got = collected(line_dedup.digest(line_dedup.drop_repeated_lines(frame(spark, rows))))
    assert got == lines_brute(rows)


def test_line_query_and_its_sql(spark):
    import duckdb
    got = queries.QUERIES["op13_line_dedup"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(got) == lines_brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert sorted(con.execute(queries.ORACLE_SQL["op13_line_dedup"]).fetchall(), key=str) == collected(got.select("doc_id", "n_lines", "n_dropped", "kept_sha256"))
