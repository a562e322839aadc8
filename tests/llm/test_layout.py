"""WARC archives, sharding, mixing and the pipeline."""

import base64
import gzip
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from plinth.llm import decontaminate, langid, mixing, sharding, simhash, warc
from plinth.llm.common import read, scratch
from plinth.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_url_keys():
    assert warc.url_key("https://user@WWW.Example.com:443/a?b=1#c") == "com,example)/a?b=1"
    assert warc.url_key("http://a.b.c:8080") == "c,b,a:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("no url") == "no url" and warc.url_key("http://[bad") == "http://[bad"


ROWS = [(5, "http://a.com/x", "same", 1), (2, "http://a.com/x", "same", 1), (9, "http://b.org/\ty%", "same", 1), (3, None, None, 1), (4, "http://www.a.com/x", "", 1), (7, "http://c.net/\r\nWARC/1.1", "WARC/1.1\r\n\r\n\x00é", 1), (None, "http://d.io/", "z" * 70_000, 1), (8, "http://a.com/x", "WARC/1.1\r\n\r\n\x00é", 1)]


@pytest.mark.parametrize("seek", [True, False])
def test_archive_round_trip(spark, seek, monkeypatch):
    if not seek:  # as on a file system that only Spark can read
        monkeypatch.setattr(warc, "_seekable", lambda *_: None)
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string, digest int")
    got = {r.page_id: r for r in warc.digest(pages, block_lines=2).collect()}
    assert len(got) == len(ROWS)
    first = {}
    for i, _, html, _ in ROWS:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    for i, _, html, _ in ROWS:
        body = (html or "").encode()
        assert got[i].payload_bytes == len(body) and got[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        lead = first.get(html or "", i)
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if lead == i else ("revisit", lead))
    small = {r.page_id: r.record_type for r in warc.digest(pages, min_revisit_bytes=10).collect()}
    assert small[5] == "response" and small[8] == "revisit"
    assert warc.digest(pages.limit(0)).count() == 0


@pytest.mark.parametrize("most_broadcast", [500_000, 0])
def test_ties_leave_one_response(spark, most_broadcast):
    rows = [(1, "http://b.com/", "x"), (1, "http://a.com/", "x"), (2, "http://c.com/", "x"), (None, "http://d.com/", "x"), (None, "u", "y"), (None, "v", "y")]
    found = warc.decide(spark.createDataFrame(rows, "page_id bigint, url string, html string"), most_broadcast=most_broadcast)
    got = {r.url: (r.record_type, r.refers_to) for r in found.collect()}
    assert got == {"http://a.com/": ("response", None), "http://b.com/": ("revisit", 1), "http://c.com/": ("revisit", 1), "http://d.com/": ("revisit", 1), "u": ("response", None), "v": ("response", None)}


def test_archives_are_plain_gzip_and_lookups_touch_their_key(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(warc, "FILE_CHUNKS", 3)
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.com/{i % 50}", f"body {i}") for i in range(300)], "page_id bigint, url string, html string")
    where, index = warc.archive(pages, block_lines=8)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(where).collect()
    raw = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert raw.count(b"WARC/1.1\r\n") == 300 and sum(len(list(warc.members(bytes(f.content)))) for f in files) == 300
    assert len(files) > 8 and max(len(f.content) for f in files) <= 3 * 2600  # bounded, whatever the input
    wanted = pages.filter("page_id in (3, 60, 200)")
    read = []
    for seek in (True, False):
        found = warc.lookup(spark, index, warc.keys_of(wanted), seek)
        assert {r.page_id for r in found.collect()} == {i for i in range(300) if any(i % 7 == j % 7 and i % 50 == j % 50 for j in (3, 60, 200))}
        assert warc.lookup(spark, index, warc.keys_of(spark.createDataFrame([("http://none.com/",)], "url string")), seek).count() == 0
        read.append(sorted((r.page_id, bytes(r.payload).decode()) for r in warc.fetch(spark, where, found, seek).collect()))
    assert read[0] == read[1] and all(v == f"body {k}" for k, v in read[0])


def test_records_have_their_parts():
    raw = gzip.decompress(warc.record(7, "http://a.com/", "revisit", "ABC", 3, b"12345"))
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    assert fields["WARC-Profile"].endswith("identical-payload-digest") and fields["WARC-Refers-To"] == "<urn:page:3>" and fields["Content-Type"] == "application/http; msgtype=response"
    assert rest[int(fields["Content-Length"]) :] == b"\r\n\r\n" and warc.parse(raw) == (fields, b"", 5)
    assert gzip.decompress(warc._NOTHING) == b"" and warc._NOTHING[-1] == 0


def test_large_record_survives(spark):
    big = spark.createDataFrame([(1, "http://x.com/", "".join(chr(33 + (i * i) % 90) for i in range(200_000)) * 90), (2, "http://x.com/", "small")], "page_id bigint, url string, html string")
    assert sorted(r.payload_bytes for r in warc.digest(big.repartition(1)).collect()) == [5, 18_000_000]


WORKING = "key bucket stratum tie rank size share all place total row n g h u v m c id doc body copy start r before value part offset sum times whole rest tokens lang2 domain epoch budget weight cap at k first lead revisits place2 _value _part _offset".split()


@pytest.mark.parametrize("name", ["interleave", "mix", "keep_one", "clean", "recognised"])
def test_callers_columns_come_back_as_they_were(spark, name):
    """Every working name as a caller's column."""
    own = [c for c in WORKING if name != "mix" or c not in ("domain", "tokens", "epoch")]
    texts = {r.doc_id: (r.text, r.lang, r.source) for r in read(spark, SMALL, "documents").limit(40).collect()}
    rows = [(i, *t, *[f"{c}{i}" for c in own]) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id bigint", "text string", "lang string", "source string", *[f"{c} string" for c in own]]))
    bench = read(spark, SMALL, "benchmark")
    run = {
        "interleave": lambda: sharding.interleave(docs, 3, bucket_rows=7), "mix": lambda: mixing.mix(docs, 0.9, 1, bucket_rows=7), "keep_one": lambda: simhash.keep_one(docs),
        "clean": lambda: decontaminate.clean(docs, bench), "recognised": lambda: langid.recognised(docs, langid.fit(docs)),
    }
    out = run[name]()
    assert out.columns[: len(docs.columns)] == docs.columns
    found = out.select(*docs.columns).collect()
    assert found and all(tuple(r) == (r.doc_id, *texts[r.doc_id], *[f"{c}{r.doc_id}" for c in own]) for r in found)


def slow_interleaving(rows, shards, seed=42):
    """rows: [(id, source)] -> id: (shard, slot)"""
    key = {i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest() for i, _ in rows}
    by = defaultdict(list)
    for i, s in rows:
        by["n" if s is None else f"s{s}"].append(i)
    share = sorted(((k + 0.5) / len(ids), s, i) for s, ids in by.items() for k, i in enumerate(sorted(ids, key=lambda i: (key[i], i))))
    out, used = {}, Counter()
    for place, (_, _, i) in enumerate(share):
        shard = place * shards // len(rows)
        out[i] = (shard, used[shard])
        used[shard] += 1
    return out


@pytest.mark.parametrize("bucket_rows", [20_000, 30])
def test_sharding_is_the_definition(spark, bucket_rows):
    docs = frame(spark).dropDuplicates(["doc_id"])
    want = slow_interleaving([(r.doc_id, r.source) for r in docs.collect()], 8)
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(docs, 8, bucket_rows=bucket_rows).collect()} == want


def frame(spark, n=500):
    rows = [(i, None if i % 50 == 0 else f"t{i % 90} é " * (i % 9), "en", None if i % 40 == 0 else "hot" if i % 3 else f"s{i % 7}", i) for i in range(n)]
    return spark.createDataFrame(rows + rows[:3], "doc_id bigint, text string, lang string, source string, slot bigint")


@pytest.mark.parametrize("bucket_rows", [20_000, 30])
def test_sharding_laws(spark, bucket_rows):
    docs = frame(spark)
    rows = sharding.interleave(docs, 8, tie_cols=("text",), bucket_rows=bucket_rows).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == 503 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    for source, total in Counter(r.source for r in rows).items():
        for s in range(8):
            assert abs(sum(r.source == source and r.shard == s for r in rows) - total / 8) < 2
    again = sharding.interleave(docs.repartition(5), 8, tie_cols=("text",), bucket_rows=bucket_rows).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, again))[10:] == sorted((r.doc_id, r.shard, r.slot) for r in rows)[10:]
    assert sharding.interleave(docs.limit(0)).count() == 0


def test_sharding_digest(spark):
    docs = read(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in sharding.digest(docs).collect():
        assert r["size"] == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None


def slow_fill(budget, nodes):
    """nodes: {name: (cap, weight)}"""
    left, out, b = dict(nodes), {}, budget
    while left:
        total = sum(w for _, w in left.values())
        full = [n for n, (c, w) in left.items() if b * w / total >= c]
        if not full:
            return out | {n: b * w / total for n, (c, w) in left.items()}
        for n in full:
            out[n] = left.pop(n)[0]
        b = budget - sum(out.values())
    return out


def test_budgets_run_down_the_tree(spark):
    leaves = [("d0", "en", "a", 100), ("d0", "en", "b", 1000), ("d0", "de", "c", 50), ("d1", "en", "e", 5000), ("d2", "fr", "f", 10), ("d9", "(none)", "g", 300), ("d9", "en", "h", 0)]
    for share in (0.1, 0.5, 0.9, 3.0):
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"), share, 2, mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, 0.05).collect()}
        caps = defaultdict(float)
        for d, g, _, t in leaves:
            caps[d] += 2.0 * t
            caps[d, g] += 2.0 * t
        tops = slow_fill(share * sum(x[3] for x in leaves), {d: (caps[d], mixing.DOMAIN_WEIGHTS.get(d, 0.05)) for d in {x[0] for x in leaves}})
        for d in tops:
            mids = slow_fill(tops[d], {g: (caps[d, g], mixing.LANG_WEIGHTS.get(g, 0.05)) for g in {x[1] for x in leaves if x[0] == d}})
            for g in mids:
                low = slow_fill(mids[g], {s: (2.0 * t, 1.0) for a, b, s, t in leaves if (a, b) == (d, g)})
                for s, want in low.items():
                    assert got[d, g, s] == pytest.approx(want, abs=1.01)


def test_weights_of_zero_take_nothing(spark):
    leaves = [("d0", "en", "a", 100), ("d0", "de", "b", 100), ("d1", "en", "c", 100)]
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    got = {r.source: r.budget for r in mixing.budgets(table, 0.5, 2, {"d0": 1.0, "d1": 0.0}, {"de": 0.0, "en": 1.0}, 0.0).collect()}
    assert got == {"a": 150, "b": 0, "c": 0}
    assert {r.budget for r in mixing.budgets(table, 0.5, 2, {}, {}, 0.0).collect()} == {0}
    with pytest.raises(ValueError, match="negative"):
        mixing.budgets(table, 0.5, 2, {"d0": -1.0}, {}, 0.1)


def test_a_language_called_none_is_not_null(spark):
    rows = [(i, "a b c d", lang, "s") for i, lang in enumerate([None, "(none)", "((none)", "en"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    taken = Counter(r.lang for r in mixing.mix(docs, 0.5, 1, {}, {}, 1.0).collect())
    assert taken == {None: 2, "(none)": 2, "((none)": 2, "en": 2}


@pytest.mark.parametrize("bucket_rows", [20_000, 25])
def test_mixing_takes_prefixes(spark, bucket_rows):
    docs = frame(spark)
    rows = mixing.mix(docs, bucket_rows=bucket_rows).collect()
    taken = Counter((r.doc_id, r.text, r.source) for r in rows)
    assert max(taken.values()) <= 4 and rows[0].asDict().keys() >= {"domain", "tokens", "epoch", "slot"}
    assert sum(r.tokens for r in rows) <= 0.6 * sum(len((r.text or "").split()) for r in docs.collect()) + 1
    whole = sorted((r.doc_id, r.epoch, r.tokens) for r in mixing.mix(docs).collect())
    assert sorted((r.doc_id, r.epoch, r.tokens) for r in rows) == whole
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, budget_share=2.0, max_epochs=1).filter("epoch > 0").count() == 0


def slow_mix(rows, share, epochs, seed=42):
    """rows: [(id, lang, source, tokens)] -> ids taken, with budgets filled by plain loops"""
    leaf = defaultdict(list)
    for i, lang, source, n in rows:
        tail = re.search("([0-9]{1,9})$", source)
        leaf[f"d{int(tail[1]) % 4}" if tail else "other", lang, source].append((i, n))
    supply = {k: sum(n for _, n in v) for k, v in leaf.items()}
    total = lambda *head: sum(n * epochs for k, n in supply.items() if k[: len(head)] == head)
    tops = slow_fill(share * sum(supply.values()), {d: (total(d), mixing.DOMAIN_WEIGHTS.get(d, 0.05)) for d, _, _ in supply})
    out = set()
    for d, top in tops.items():
        mids = slow_fill(top, {g: (total(d, g), mixing.LANG_WEIGHTS.get(g, 0.05)) for e, g, _ in supply if e == d})
        for g, mid in mids.items():
            for s, budget in slow_fill(mid, {s: (total(d, g, s), 1.0) for e, h, s in supply if (e, h) == (d, g)}).items():
                n, budget = supply[d, g, s], math.floor(budget + 1e-6)
                whole = min(budget // n, epochs) if n else 0
                left, order = budget - whole * n, sorted(leaf[d, g, s], key=lambda x: (hashlib.md5(f"{seed}|{whole}|{x[0]}".encode()).hexdigest(), x[0]))
                sums = itertools.accumulate(x[1] for x in order)
                out |= {i for (i, _), upto in zip(order, sums) if whole or left > 0 and upto <= left}
    return out


def test_pipeline_stages_against_brute_force(spark):
    from test_duplicates import slow_components, slow_fingerprint, slow_matches

    docs = read(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    texts = {i: r.text for i, r in rows.items()}
    odd = docs.unionByName(spark.createDataFrame([(900_001, "123 456", "en", "src0", 7), (900_002, None, None, None, None), (900_003, texts[5].upper(), "es", "src1", 9), (900_004, "½ ²", "en", "src1", 3)], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    profiles = langid.fit(odd)
    told = {r.doc_id: profiles.predict(r.text) for r in odd.collect()}
    want = {i: lang for i, (lang, score) in told.items() if lang in corpus_pipeline.TARGET_LANGS and score >= corpus_pipeline.LEAST_SCORE}
    known = stages["language_id"](spark, odd, SMALL)
    assert {r.doc_id: r.lang for r in known.collect()} == want and known.columns == docs.columns
    assert not {900_001, 900_002, 900_004} & set(want) and want[900_003] == rows[5].lang
    one = stages["simhash_near_dedup"](spark, known, SMALL)
    prints = {i: slow_fingerprint((texts | {900_003: texts[5].upper()})[i]) for i in want}
    assert {r.doc_id for r in one.collect()} == set(slow_components(prints).values()) and one.columns == docs.columns
    clean = stages["benchmark_decontamination"](spark, docs, SMALL)
    items = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    dirty = {i for i, _ in slow_matches(list(texts.items()), items)}
    assert dirty and {r.doc_id for r in clean.collect()} == set(texts) - dirty
    mixed = stages["source_mixing"](spark, docs, SMALL)
    taken = slow_mix([(i, r.lang, r.source, len((r.text or "").encode().split())) for i, r in rows.items()], corpus_pipeline.BUDGET_SHARE, corpus_pipeline.EPOCHS)
    assert mixed.columns == docs.columns and sorted(r.doc_id for r in mixed.collect()) == sorted(taken) and len(taken) < len(texts)
    placed = stages["sharding"](spark, docs, SMALL)
    assert {r.doc_id: (r.shard, r.slot) for r in placed.collect()} == slow_interleaving([(i, r.source) for i, r in rows.items()], 8)
    assert all(f(spark, docs.limit(0), SMALL).count() == 0 for f in stages.values())


def test_every_operator_has_its_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


def test_scratch_is_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch(spark, "x").startswith(named.rstrip("/") + "/")
