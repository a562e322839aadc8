"""Centroid clustering, token files and the conversation trie."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from plinth.llm import centroids, tokenfiles, trie
from plinth.llm.common import scratch

SPEC = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
CLASH = ["id", "v", "x", "c", "i", "n", "key", "cluster", "distance", "conv", "pos", "part", "node", "depth", "text2", "tie", "size", "frame", "file"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).alias(c) for c in CLASH if c not in df.columns])


# --- clustering ---------------------------------------------------------------------------------------------------


def lloyd(rows, k, rounds, dim):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    cents = [v for _, v in sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(cents)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, d, j in found:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, cents[j])))) for i, d, j in found), key=str)


def test_clusters_equal_plain_rounds(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.3, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)] + [(5, [1.0, 1.0, 1.0, 1.0])] * 3  # copies, repeated ids
    rows += [(300, None), (301, [1.0]), (302, [1.0, None, 1.0, 1.0]), (303, [float("nan")] * 4), (304, [math.inf, 0.0, 0.0, 0.0]), (305, []), (None, [0.1, 0.2, 0.3, 0.4])]
    df = with_clashes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    found, final = centroids.cluster(df, 6, 10, dim=4)
    got = sorted(((r["id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], sha(",".join(map(str, final[r["cluster"]].tolist())))) for r in found.collect()), key=str)
    assert got == lloyd(rows, 6, 10, 4)


def test_few_or_no_vectors(spark):
    shape = "vec_id bigint, embedding array<float>"
    assert centroids.digest(spark.createDataFrame([], shape)).collect() == []
    assert centroids.digest(spark.createDataFrame([(1, [1.0])], shape)).count() == 0
    two = centroids.digest(spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64)], shape)).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in two) == [(1, 0, 0), (2, 0, 0)] and len({r.cluster for r in two}) == 2
    with pytest.raises(Exception, match="too large"):
        centroids.digest(spark.createDataFrame([(1, [1e30] * 64)], shape)).collect()


@pytest.mark.parametrize("spread", [1, 40, 1 << 23])
def test_annulus_finds_ties_at_its_border_and_prunes(spread):
    rng = np.random.default_rng(3)
    cents = rng.integers(-spread, spread + 1, (300, 8)) * 3
    cents[7] = cents[3]  # equal centroids: the smaller number wins
    x = np.concatenate([rng.integers(-3 * spread, 3 * spread + 1, (500, 8)), cents[:50], np.zeros((1, 8), dtype=np.int64)])
    search = centroids.Annulus(cents)
    number, distance = search.nearest(x)
    every = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert spread == 1 or search.compared < every.size


# --- token files --------------------------------------------------------------------------------------------------

TEXTS = [
    None, "", " \t\n", "Plain words, twice. Plain words, twice!", "It's we'll THEY'RE don't.", "Ünïcödé ÀÉ ß ÿ × ÷ Σας İı", "ạ́ ́b H̱ ̈́", " nbsp em　wide\x1cfs\x85nel",
    "<|endoftext|> is text", "日本語 한글 🎉🎉 ½Ⅷ 012", "...;;; ,a. a,", "x" * 5000, "word " * 3000,
]


def want(rows):
    t = Tokenizer.from_str(SPEC)
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_have_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokenfiles, "_PIECE", 64)
    rng, t = random.Random(1), Tokenizer.from_str(SPEC)
    t.encode_special_tokens = True
    letters = "aAbZzéÉßÿ×÷İΣσς.,;!?'s'T \t\n\x0b\x1c\x85   0129½Ⅷ́̈H̱h<>=日本語한글🎉̈́"
    texts = [x or "" for x in TEXTS] + ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(1500)]
    for few in (400_000, 50):
        encoder = tokenfiles.Encoder(SPEC, 1, most=few)
        assert encoder.by_word
        for text in texts:
            assert np.frombuffer(encoder(text), encoder.kind).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]
    other = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    whole = tokenfiles.Encoder(other, 1)
    assert not whole.by_word
    assert [np.frombuffer(whole(x), whole.kind).tolist()[:-1] for x in ("a  b", "")] == [Tokenizer.from_str(other).encode(x, add_special_tokens=False).ids for x in ("a  b", "")]


@pytest.mark.parametrize("seek", [True, False])
def test_files_give_back_what_was_written(spark, seek, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CHUNK_BYTES", 200)
    monkeypatch.setattr("plinth.llm.warc.FILE_CHUNKS", 2)
    rows = [(i * 3 % 17, x) for i, x in enumerate(TEXTS)] + [(100 + i, f"filler text number {i}") for i in range(60)]
    rng = random.Random(2)
    rng.shuffle(rows)
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted(tuple(r) for r in tokenfiles.digest(df, public_tokenizers.path("word_bpe_49k.json"), seek=seek).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want(sorted(rows, key=lambda r: r[0]))


def test_repeated_and_null_ids_keep_every_row(spark):
    rows = [(None, "a b"), (None, None), (4, "same"), (4, "same"), (4, "other"), (-1, "minus")]
    got = sorted((tuple(r) for r in tokenfiles.digest(spark.createDataFrame(rows, "doc_id bigint, text string"), public_tokenizers.path("word_bpe_49k.json")).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    assert [r[1] for r in got] == [None, None, -1, 4, 4, 4] and [r[0] for r in got] == [sum(x[2] for x in got[:i]) for i in range(6)]
    assert sorted(r[2:] for r in got) == sorted(w[2:] for w in want(rows))
    assert tokenfiles.digest(spark.createDataFrame([], "doc_id bigint, text string"), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_files_are_plain_streams_and_single_documents_are_read_by_range(spark):
    rows = [(i, f"document {i} says much the same as document {i + 1}") for i in range(200)]
    path = scratch(spark, "tokens-test")
    tokenfiles.write(spark.createDataFrame(rows, "doc_id bigint, text string"), path, SPEC, 1, sample_docs=150)
    found = {r.doc_id: r.ids for r in tokenfiles.read(spark, path, spark.createDataFrame([(17,), (17,), (999,)], "doc_id int")).collect()}
    t = Tokenizer.from_str(SPEC)
    assert found == {17: [*t.encode(rows[17][1], add_special_tokens=False).ids, 1]}
    stored = spark.read.parquet(f"{path}/dictionary").first()
    assert hashlib.sha256(stored["dictionary"]).hexdigest() == stored["hash"]
    assert {r.dictionary for r in spark.read.parquet(f"{path}/index").collect()} == {stored["hash"]}
    ids, unzip = [], zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(stored["dictionary"])))
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").orderBy("path").collect():
        with unzip.stream_reader(bytes(r.content), read_across_frames=True) as stream:  # any reader passes over what is no document
            ids += np.frombuffer(stream.read(), "<u2").tolist()
    assert ids == [x for _, text in rows for x in [*t.encode(text, add_special_tokens=False).ids, 1]]


# --- trie ---------------------------------------------------------------------------------------------------------


def plain_trie(sequences):
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    out = []
    for node, convs in members.items():
        under = [x for x in members if x[: len(node)] == node]
        saves = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in under)
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), sum(not kids[x] for x in under), saves, sha(ends)))
    return sorted(out, key=str)


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), r or "", x or ""))
    turns = {c: [x[3:] for x in sorted(xs)] for c, xs in own.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    return {c: turns.get(c - c % 100, [])[: h(c)] + turns[c][h(c) :] for c in turns}


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_equals_plain_prefixes(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for c in [*range(40), *range(100, 130), *range(205, 225)] for t in range(rng.choice([1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", f"hot {t}") for c in range(300, 340) for t in range(7)]  # one conversation many times
    rows += [(500, t, "user", "again") for t in range(70)] + [(503, t, "user", "again") for t in range(41)]  # long ones
    rows += [(600, None, None, None), (600, 1, "user", "x"), (600, 1, "user", "x"), (600, 1, "user", "a"), (600, None, "user", ""), (None, 0, "user", "nobody's")]
    rows += [(601, 0, "ab", "c"), (602, 0, "a", "bc"), (700, 0, "", "🎉é"), (701, 1, None, "🎉é")]
    rng.shuffle(rows)
    df = with_clashes(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert sorted((tuple(r) for r in trie.digest(df).select(*NODE).collect()), key=str) == plain_trie(rebuilt(rows))
    # as they are, with stretches of a few turns
    turns, names = trie.ordered(df)
    found = trie.saved(trie.members(*trie.as_they_are(turns)), "trie-test")
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), r or "", x or ""))
    plain = plain_trie({c: [x[3:] for x in sorted(xs)] for c, xs in own.items()})
    for stretch in (20_000, 4):
        assert sorted((tuple(r) for r in trie.nodes(found, stretch).select(*NODE).collect()), key=str) == plain
    told = {r.turn: (r.role, r.text) for r in trie.contents(df, names).collect()}
    first = {told[r.turn] for r in trie.nodes(found).filter("depth = 1").collect()}
    assert first == {sorted(xs)[0][3:] for xs in own.values()}


def test_many_endings_are_hashed_as_a_stream(spark, monkeypatch):
    monkeypatch.setattr(trie, "_PIECE", 50)
    rows = [(c, 0, "user", "same") for c in range(0, 9000, 100)] + [(50, 0, "user", "other")]
    got = trie.prefix_trie(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))[0]
    ends = {(r.depth, r.conv_id): r.ends_sha256 for r in got.collect()}
    assert ends == {(0, 0): sha(""), (1, 0): sha(",".join(str(c) for c in range(0, 9000, 100))), (1, 50): sha("50")}


def test_empty_and_turnless(spark):
    shape = "conv_id bigint, turn bigint, role string, text string"
    assert trie.digest(spark.createDataFrame([], shape)).collect() == []
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)  # its first turns are gone and its head is absent
    assert [tuple(r) for r in trie.digest(spark.createDataFrame([(c, 0, "user", "x")], shape)).select(*NODE).collect()] == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]
