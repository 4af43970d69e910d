"""Sharding, packing and decontamination: laws, exact round trips and brute force."""

import collections
import re
import zlib

import numpy as np
import pytest

from audience_engine.llm import decontaminate, packing, queries
from audience_engine.llm.sharding import shard_documents, write_shards

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "b", 2) for i, t in rows], "doc_id long, text string, shard int, key string, row int")


# -- sharding -------------------------------------------------------------------------

def check_shards(got, rows, shards):
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in rows)
    text = dict(rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < shards
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(size.values()), max(r["size"] for r in got)
    for s in range(shards):
        assert abs(size[s] - total / shards) <= largest + 0.02 * total / shards + 1


def test_shards_of_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text").collect()]
    check_shards(queries.QUERIES["op5_sharding"](spark, SF2).collect(), rows, 24)


def test_a_hot_text_is_subdivided(spark):
    rows = [(i, f"text {i} " * (1 + i % 9)) for i in range(2000)] + [(5000 + i, "the hot text") for i in range(1500)] + [(9000, None), (9001, ""), (9002, "é" * 50)]
    got = shard_documents(frame(spark, rows), shards=8).collect()
    check_shards(got, rows, 8)
    of = collections.defaultdict(set)
    for r in got:
        if r.doc_id < 2000:
            of[dict(rows)[r.doc_id]].add(r.shard)
    assert sum(len(s) == 1 for s in of.values()) == len(of)  # other copies stay together


def test_pairs_beside_a_hot_text_stay_together(spark):
    """Only the copies of a text that is itself over a range are split; groups that shared its range are not."""
    rows = [(2 * i + j, f"pair {i} of some length") for i in range(4000) for j in range(2)] + [(50_000 + i, "the hot text") for i in range(6000)]
    got = shard_documents(frame(spark, rows), shards=8, cells_per_shard=4, draws_per_cell=8).collect()
    check_shards(got, rows, 8)
    of = collections.defaultdict(set)
    for r in got:
        if r.doc_id < 50_000:
            of[r.doc_id // 2].add(r.shard)
    assert len(of) == 4000 and all(len(s) == 1 for s in of.values())


def test_shards_of_null_ids_and_repeated_rows(spark, tmp_path):
    rows = [(None, "a"), (None, "a"), (None, None), (None, ""), (1, "x"), (1, "x"), (1, "y"), (2, "x")]
    df = frame(spark, rows)
    plan = shard_documents(df, shards=2).collect()
    assert collections.Counter((r.doc_id, r.text_crc32) for r in plan) == collections.Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    write_shards(df, str(tmp_path / "s"), shards=2, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter(rows)
    slots = collections.defaultdict(list)
    for r in back:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_files_and_empty(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)] + [(50, None)]
    plan = write_shards(frame(spark, rows), str(tmp_path / "s"), shards=4, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in plan.collect())
    assert set(back.columns) == {"doc_id", "text", "key", "row", "shard", "slot"}
    assert shard_documents(frame(spark, rows).where("doc_id < 0")).count() == 0


# -- packing --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return packing.tokenizer_json()


ODD = [(1, None), (2, ""), (3, "Don't stop 'tis I'LL"), (4, "a<|startoftext|>b <|endoftext|>"), (5, "word*** ***word (x) \"y\" ß É Ñandú a´ . .. ..."),
       (6, "１２ 3.5 a1b2 漢字 İstanbul ΑΣ ς é"), (7, "l'homme c'est ªº 1ª nª µm Ÿ \x85x\xa0y"), (8, "the " * 9000), (9, "x" * 3000), (10, "same"), (11, "same"), (11, "same")]


def exact_ids(vocabulary, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(vocabulary).encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, got, vocabulary, capacity):
    want = collections.Counter()
    for i, t in rows:
        ids = exact_ids(vocabulary, t)
        for k, s in enumerate(range(0, len(ids), capacity)):
            cut = ids[s:s + capacity]
            want[(i, k, s, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity
    return len(places)


def test_pack_edges_and_round_trip(spark, vocabulary):
    packed = packing.pack(frame(spark, ODD), vocabulary, capacity=64)
    check_packed(ODD, packed.collect(), vocabulary, 64)
    assert packing.pack(frame(spark, ODD).where("doc_id < 0"), vocabulary).count() == 0
    once = ODD[:-1]
    packed = packing.pack(frame(spark, once), vocabulary, capacity=64)
    got = {r.sequence_id: r.ids for r in packing.sequences(frame(spark, once), packed, vocabulary, 64).collect()}
    ids = {i: exact_ids(vocabulary, t) for i, t in once}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]


def test_pack_query_is_near_the_lower_bound(spark, vocabulary):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op7_packing"](spark, SF).collect()
    n = check_packed(rows, got, vocabulary, 4096)
    assert n <= 1.02 * -(-sum(r.length for r in got) // 4096) + 1


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    h = np.bincount(np.clip(rng.lognormal(6, 1, 30000).astype(int), 1, 4096), minlength=4097)
    runs = packing.plan(h, 4096)
    used, load = np.zeros(4097, dtype=int), collections.Counter()
    for v, first, seq, n, offset in zip(*[runs[k] for k in ("length", "first", "seq", "n", "offset")]):
        assert first == used[v]
        nxt = [f for w, f in zip(runs["length"], runs["first"]) if w == v and f > first]
        count = (min(nxt) if nxt else h[v]) - first
        assert count % n == 0
        used[v] += count
        load[(seq, n)] += count // n * v
    assert (used == h).all() and max(load.values()) <= 4096
    assert sum(n for _, n in load) <= 1.005 * -(-(h * np.arange(4097)).sum() // 4096) + 1


# -- decontamination ------------------------------------------------------------------

def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])


def leaks(docs, items, percent=80):
    out = {}
    for i, t in items:
        own = shingles(t)
        if not own:
            continue
        m, weights = len(own), collections.Counter(own)
        for d, x in docs:
            s = shingles(x)
            if not weights.keys() & set(s):
                continue
            best = 0
            for p in range(-m + 1, len(s)):
                w = collections.Counter(s[max(p, 0):p + m])
                both, every = sum((weights & w).values()), sum((weights | w).values())
                best = max(best, both / every)
            if 100 * best >= percent:
                out[d, i] = best
    return out


def test_leaks_on_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.QUERIES["op4_decontamination"](spark, SF).collect()}
    want = leaks(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_leak_edges(spark):
    item = " ".join(f"Item{i}" for i in range(40))
    changed = item.split()
    changed[20] = "other"
    docs = [(1, None), (2, ""), (3, "before it " + item.upper() + " after it"), (4, " ".join(item.split()[:38])), (5, " ".join(item.split()[:20])),
            (6, "x " * 3000 + item), (7, "short item"), (8, "a short item here"), (9, " ".join(changed[15:]) + " z"), (10, (item + " ") * 3), (11, item), (11, item),
            (12, "same same same same same same same same")]
    items = [(1, item), (2, "Short item"), (3, None), (4, ""), (5, "same same same same same same same same"), (6, item)]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    frm = frame(spark, docs)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(frm, bench).collect()}
    want = leaks(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    kept = decontaminate.drop_contaminated(frm, bench)
    assert kept.columns == frm.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if not any(i == d for d, _ in want))
    assert decontaminate.contaminated(frm, bench.where("item_id < 0")).count() == 0
    assert decontaminate.contaminated(frm.where("doc_id < 0"), bench).count() == 0


def test_no_near_copy_is_lost_beyond_the_radius(spark):
    """One changed word of 50 is similarity 0.804: some fingerprints are further apart than the multi-index sees."""
    n, items, docs = 1000, [], []
    for i in range(n):
        words = [f"i{i}w{j}" for j in range(50)]
        items.append((i, " ".join(words)))
        words[10 + i % 30] = "other"
        docs.append((i, f"before {i} " + " ".join(words) + " after"))
    docs += [(n + i, " ".join(f"i{i}w{j}" if j % 9 else "other" for j in range(50))) for i in range(50)]  # shares shingles only
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, docs), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(n)]
    assert all(abs(r.similarity - 41 / 51) < 1e-9 for r in got)
