"""SimHash, I-Match, repeated substrings, decontamination: against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plinth.llm import decontaminate, graph, imatch, rolling, simhash, substrings

SCHEMA = "doc_id bigint, text string, fp bigint, w string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], SCHEMA)


def words(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def slow_fingerprint(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    runs = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    ones = [0] * 64
    for x in runs:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(runs))


def test_blocks_cover_every_five_positions():
    blocks = [set(b) for b in simhash._blocks()]
    assert len(blocks) == 14 and all(any(b <= set(five) for b in blocks) for five in itertools.combinations(range(8), 5))


def test_fingerprint_is_the_definition():
    rng = random.Random(1)
    for text in ["", "one", "one Two", "É é A a", words(rng, 50), words(rng, 9000)]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def slow_components(prints):
    """ids -> smallest reachable id"""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("cap", [4096, 3])
def test_links_match_brute_force(spark, cap):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for base in prints[:6]:  # chains and clusters, some of them longer than the small cap
        x = base
        for _ in range(12):
            for _ in range(rng.choice([1, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
            prints.append(x)
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), cap)
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    got = {i: roots.get(signed[i], signed[i]) for i in range(len(prints))}
    want = slow_components(dict(enumerate(prints)))
    for a, b in itertools.combinations(range(len(prints)), 2):
        assert (got[a] == got[b]) == (want[a] == want[b])


def test_near_duplicates_and_keep_one(spark):
    rng = random.Random(2)
    texts = [words(rng, 60) for _ in range(8)]
    texts += [texts[0], texts[0].upper(), "", None, "   ", texts[3] + "  "]
    frame = docs_of(spark, texts)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame).collect()}
    prints = {i: slow_fingerprint(t or "") for i, t in enumerate(texts)}
    want = slow_components(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    kept = simhash.keep_one(frame.unionByName(frame.filter("doc_id = 1")))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d", 1, ""), (None, "a b c d", 1, "z"), (3, "x y z", 1, ""), (None, "q r s t", 1, ""), (5, "x y z", 1, ""), (5, "k l m n", 1, "")], SCHEMA)
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(nameless).collect()) == [(0, "a b c d"), (0, "q r s t"), (3, "x y z"), (5, "k l m n")]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {500: 500}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def slow_removal(rows, width=20):
    """rows: [(key, text)] in order -> key: (n_words, n_removed, digest)"""
    seen, out = set(), {}
    for key, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - width + 1):
            x = tuple(w[a : a + width])
            if x in seen:
                gone[a : a + width] = [True] * width
            seen.add(x)
        out[key] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize(("most_broadcast", "least_hot", "hot_tasks"), [(500_000, 4096, 2.0), (0, 0, 0.0), (0, 2, 0.01)])
def test_substrings_match_brute_force(spark, most_broadcast, least_hot, hot_tasks):
    rng = random.Random(9)
    passages = [words(rng, n, 500) for n in (20, 21, 25, 60, 200)]
    texts = []
    for i in range(40):
        parts = [words(rng, rng.randrange(0, 40), 500)]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randrange(0, 5)
            parts += [" ".join(p[a : len(p) - rng.randrange(0, 4)]), words(rng, rng.randrange(0, 10), 500)]
        texts.append(rng.choice([" ", "\n"]).join(parts))
    texts += [None, "", "loop " * 90, "a b " * 60, texts[3], texts[3] + " tail", " \t" + texts[5] + "\u00a0é\n", "é" * 30]
    got = {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in substrings.remove_repeats(docs_of(spark, texts), most_broadcast=most_broadcast, least_hot=least_hot, hot_tasks=hot_tasks).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()}
    assert got == slow_removal(list(enumerate(texts)))


def cut(texts, width=20, k=10):
    """(text, least k-mer, segment, start, windows) of all segments"""
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    h, first = substrings.word_hashes(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert np.diff(first).tolist() == [len(t.split()) for t in data]
    return h, first, [tuple(int(v) for v in x) for s in substrings.segments(h, first, width, k) for x in zip(*s)]


def test_segments_in_pieces(monkeypatch):
    rng = random.Random(4)
    texts = [words(rng, 300, 9), "", "short one", "  " + words(rng, 200, 9) + "\n", words(rng, 19, 9), words(rng, 20, 9)]
    h, first, whole = cut(texts)
    assert sum(x[4] for x in whole) == sum(max(0, len(t.split()) - 19) for t in texts)
    alone = [(i, *x[1:]) for i, t in enumerate(texts) for x in cut([t])[2]]
    assert sorted(alone) == sorted(whole)  # a segment depends on its words alone
    monkeypatch.setattr(substrings, "_PIECE", 64)
    monkeypatch.setattr(substrings, "_TEXT", 50)
    monkeypatch.setattr(rolling, "_tables", {})
    g, again, parts = cut(texts)
    assert (g == h).all() and (again == first).all()
    covered = lambda xs: sorted((x[0], x[3] + i, x[1]) for x in xs for i in range(x[4]))
    assert covered(parts) == covered(whole)


def test_spans_are_longest_and_name_their_source(spark):
    p = " ".join(f"p{i}" for i in range(50))
    frame = docs_of(spark, ["x " + p, "y z " + p + " end", p + " tail " + p])
    _, spans = substrings.repeats(frame)
    texts = {0: ["x", *p.split()], 1: ["y", "z", *p.split(), "end"], 2: [*p.split(), "tail", *p.split()]}
    rows = sorted((r.doc.id, r.start, r.r, r.src.id, r.src_start, bytes(r.sha)) for r in spans.collect())
    assert rows[0] == (1, 2, 31, 0, 1, hashlib.sha256(p.encode()).digest())  # one path, not a piece per segment
    for doc, start, r, src, src_start, sha in rows:
        run = texts[doc][start : start + r + 19]
        assert (src, src_start) < (doc, start) and run == texts[src][src_start : src_start + r + 19] and sha == hashlib.sha256(" ".join(run).encode()).digest()
    assert sorted(s + i for d, s, r, *_ in rows for i in range(r) if d == 2) == [*range(31), *range(51, 82)]


def test_other_words_than_the_source_stop_the_job(spark):
    kind = "id bigint, body binary, spans array<struct<start:int,r:int,sha:binary>>"
    rows = spark.createDataFrame([(1, ("a " * 20).encode(), [(0, 1, hashlib.sha256(b"other").digest())])], kind)
    with pytest.raises(Exception, match="differ from their source"):
        substrings._kept(rows, 20).collect()


def test_substring_odd_rows(spark):
    p = " ".join(f"p{i}" for i in range(50))
    frame = docs_of(spark, ["x " + p, "y z " + p + " end"])
    same = frame.unionByName(frame.filter("doc_id = 0"))
    kept = sorted((r.doc_id, r.n_removed) for r in substrings.remove_repeats(same).collect())
    assert kept == [(0, 0), (0, 51), (1, 50)]
    assert substrings.remove_repeats(frame.limit(0)).count() == 0
    nulls = frame.unionByName(spark.createDataFrame([(None, p, 7, "x"), (None, p, 7, "x"), (None, None, 7, "x")], SCHEMA))
    kept = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(nulls).collect())
    assert kept == [(-1, 0, 0), (-1, 50, 0), (-1, 50, 50), (0, 51, 50), (1, 53, 50)]
    named = frame.selectExpr("concat('k', doc_id) as doc", "text as body", "1 as id")
    assert sorted((r.doc, r.n_removed) for r in substrings.remove_repeats(named, id_col="doc", text_col="body").collect()) == [("k0", 0), ("k1", 50)]
    assert substrings._numbered(nulls, "doc_id", "text", bucket_rows=1).select("doc").distinct().count() == 5


def slow_matches(docs, items, threshold=0.8):
    import regex

    def shingles(text):
        w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    out = set()
    for i, d in docs:
        for j, t in items:
            s = shingles(t)
            if s and len(s & shingles(d)) >= np.ceil(len(s) * threshold - 1e-9):
                out.add((i, j))
    return out


@pytest.mark.parametrize(("block", "most_broadcast"), [(1_000_000, 2_000_000), (7, 0)])
def test_decontamination_matches_brute_force(spark, block, most_broadcast):
    rng = random.Random(8)
    items = [words(rng, n, 300) for n in (3, 5, 6, 9, 14, 30, 31, 59)] + [None, "", "!!!"]
    texts = []
    for _ in range(30):
        t = rng.choice(items[:8]).split()
        for _ in range(rng.randrange(0, 4)):
            t[rng.randrange(len(t))] = "changed"
        texts.append(words(rng, rng.randrange(0, 80), 300) + " " + ", ".join(t).upper() + "\n" + words(rng, rng.randrange(0, 80), 300))
    texts += [None, "", items[0], items[5] + " " + items[6]]
    frame = docs_of(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame, bench, block_hashes=block, most_broadcast=most_broadcast).collect()}
    assert got == slow_matches(list(enumerate(texts)), list(enumerate(items)))
    hit = {i for i, _ in got}
    assert sorted(r.doc_id for r in decontaminate.clean(frame, bench).collect()) == [i for i in range(len(texts)) if i not in hit]
    assert decontaminate.matches(frame.limit(0), bench).count() == 0 and decontaminate.matches(frame, bench.limit(0)).count() == 0


def test_signature_is_long_enough(spark):
    rng = random.Random(3)
    items = spark.createDataFrame([(n, words(rng, n + 4, 10**6)) for n in range(1, 70)], "item_id bigint, text string").select("item_id", decontaminate.words("text").alias("w"))
    sizes = {r.item_id: r["count"] for r in decontaminate.signatures(items, 0.8).groupBy("item_id").count().collect()}
    assert all(sizes[n] >= min(n, n - int(np.ceil(0.8 * n - 1e-9)) + 1) for n in sizes) and len(sizes) == 69


def test_imatch_contract(spark):
    rng = random.Random(6)
    texts = [words(rng, rng.randrange(1, 200), 3000) for _ in range(60)] + ["", None, "z", "z"]
    frame = docs_of(spark, texts)
    lexicon = imatch.fit(frame)
    rows = {r.doc_id: r for r in imatch.fingerprints(frame.repartition(3), lexicon).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        nxt = plain[(i + 1) % len(plain)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        assert rows[i].n_chars == len(t) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].fingerprint == lexicon.fingerprint(t) and 0 <= rows[i].near_next <= 1 and 0 <= rows[i].near_edited <= 1
    assert rows[62].fingerprint == rows[63].fingerprint
    long = [i for i, t in enumerate(plain) if len(t) > 300]
    assert np.mean([rows[i].near_edited for i in long]) > np.mean([rows[i].near_next for i in long]) + 0.3


def slow_imatch(texts, least=1 / 2000, most=0.2, subsets=32, per=2.0, seed=42):
    """Fingerprints by plain loops over Python integers."""
    full = (1 << 64) - 1

    def mixed(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ h >> 27) * 0x94D049BB133111EB & full
        return h ^ h >> 31

    def term(w):
        h = sum((ord(c) + 1) * pow(imatch._BASE, i, 1 << 64) for i, c in enumerate(w)) & full
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & full
        return (h ^ h >> 29) + len(w) & full

    own = [{term(w) for w in re.findall(r"[^\W_]+", t.lower())} for t in texts]
    count = Counter(h for hs in own for h in hs)
    band = {h for h, n in count.items() if max(1.0, least * len(texts)) <= n <= most * len(texts)}
    out = []
    for t, hs in zip(texts, own):
        kept = sorted(hs & band)
        if not kept:
            out.append("t" + xxhash.xxh64_hexdigest(t.encode()))
            continue
        parts = ""
        for j in range(subsets):
            key = mixed((j // 2 + 1) * 0x9E3779B97F4A7C15 + seed & full)
            level = max(0, math.floor(math.log2(len(kept) / per) + (j + 0.5) / subsets))
            chosen = [h for h in kept if (mixed(h ^ key) >> 32 * (j % 2) & 0xFFFFFFFF) < 1 << (32 - level)]
            data = b"".join(h.to_bytes(8, "little") for h in chosen)
            parts += f"{xxhash.xxh32_intdigest(data, seed) or 1:08x}" if chosen else "00000000"
        out.append(parts)
    return out


def test_imatch_is_the_definition(spark):
    rng = random.Random(16)
    texts = [words(rng, rng.randrange(0, 300), 900) + rng.choice(["", " Éa ½x _ under_score"]) for _ in range(50)] + ["", "w1", "!!"]
    frame = docs_of(spark, texts).repartition(4)
    got = {r.doc_id: r.fingerprint for r in imatch.fingerprints(frame, imatch.fit(frame)).collect()}
    assert [got[i] for i in range(len(texts))] == slow_imatch(texts)


def test_terms_in_pieces_equal_whole(monkeypatch):
    text = "The Été_x ½ 12ab 😀b, É. " * 30 + "long" * 50
    whole = imatch.terms(text)
    monkeypatch.setattr(imatch, "_PIECE", 7)
    assert (imatch.terms(text) == whole).all() and len(whole) == len(set(re.findall(r"[^\W_]+", text.lower())))


def test_imatch_takes_ids_of_any_type(spark):
    texts = [f"text number {i} of many words" for i in range(30)]
    rows = [(f"k{i:02}", t, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "name string, body string, id string").repartition(3)
    got = {r.name: r.edited_sha256 for r in imatch.fingerprints(frame, imatch.fit(frame, text_col="body"), "name", "body").collect()}
    for i, t in enumerate(texts):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + texts[(i + 1) % 30][:cut]
        assert got[f"k{i:02}"] == hashlib.sha256(edited.encode()).hexdigest()


def test_imatch_odd_rows(spark):
    one = docs_of(spark, ["only one text here"])
    row = imatch.fingerprints(one, imatch.fit(one)).collect()
    assert len(row) == 1 and row[0].near_next == 1.0
    odd = spark.createDataFrame([(None, "a", 1, ""), (4, None, 1, ""), (4, "b", 1, ""), (2, "c" * 100, 1, "")], SCHEMA)
    assert imatch.fingerprints(odd, imatch.fit(odd)).count() == 4
    assert imatch.fingerprints(odd.limit(0), imatch.fit(odd.limit(0))).count() == 0
