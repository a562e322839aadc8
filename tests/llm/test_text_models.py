"""Quality ranking, language profiles and main-text extraction."""

import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from plinth.llm import htmltext, langid, quality
from plinth.llm.common import read

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"
ODD = [(1, None, None, None, None, 1.0), (2, "", "en", "a", 0, 1.0), (3, "12 34 !!", "en", "a", 8, 1.0), (4, "word " * 300_000, "en", None, 0, 1.0), (5, "same", "de", "a", 4, 1.0), (5, "same", "de", "a", 4, 1.0), (None, "no id", "en", "a", 5, 1.0)]


def test_quality_held_out_accuracy(spark):
    docs, labels = read(spark, SMALL.replace("0.001", "0.01"), "documents"), read(spark, SMALL.replace("0.001", "0.01"), "labels")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").filter("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert all(rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id])


def slow_features(text):
    """The features by plain counts over characters, words and lines."""
    letters = [c for c in text if c.isalpha() or ord(c) > 65535]
    upper, digits = [c for c in text if c.isupper() and ord(c) < 65536], [c for c in text if c.isdigit() and not c.isalpha() and ord(c) < 65536]
    marks = [c for c in text if c in ".,;:!?'\"()-"]
    noise = [c for c in text if not (c.isspace() or c.isalpha() or c.isdigit() or c.isupper()) and c not in ".,;:!?'\"()-" and ord(c) < 65536]
    w = text.split()
    n, m, chars = len(w), max(len(w), 1), max(len(text), 1)
    runs = [len(list(g)) - 1 for _, g in itertools.groupby(w)]
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(n), min(len(letters) / m, 30.0), len(upper) / max(len(letters), 1), len(letters) / chars, len(marks) / chars, len(noise) / chars, len(digits) / chars,
        min((len(marks) + len(noise)) / m, 10.0), len(set(w)) / m, len(set(w)) / math.sqrt(m) / 10, sum(a == b for a, b in zip(w, w[1:])) / m, math.log1p(max(runs, default=0)),
        max(map(w.count, set(w)), default=0) / m, len(set(zip(w, w[1:]))) / m, 1 - len(set(lines)) / max(len(lines), 1), math.log1p(n / max(len(lines), 1)),
        sum(not any(c.isalpha() for c in x) for x in w) / m, sum(len(x) > 20 for x in w) / m,
    ]


def test_quality_features_are_plain_counts():
    texts = ["", "a a a b B! 12 ?? \n\nline\nline", "123456789letters 12345678 " + "x" * 25, "É½² 😀 𝒜 ß\u00a0z", " \n ", "One, two; three. " * 40]
    for t in texts:
        assert quality.features(t) == pytest.approx(slow_features(t))
    assert quality.features(None) == quality.features("")


def test_quality_of_repeated_and_contradictory_labels(spark):
    docs = spark.createDataFrame([(i, "good words here, they are fine. " * 5 if i % 2 else "### 12 !! ### 12 !!") for i in range(60)], "doc_id bigint, text string")
    plain = [(i, i % 2) for i in range(60)]
    one = quality.fit(docs, spark.createDataFrame(plain, "doc_id bigint, quality int"))
    odd = quality.fit(docs, spark.createDataFrame(plain + plain[:9] + [(None, 1), (3, None), (999, 0)], "doc_id bigint, quality int"))
    assert np.allclose(one.weights, odd.weights)
    mixed = quality.fit(docs, spark.createDataFrame(plain + [(1, 0), (1, 0)], "doc_id bigint, quality int"))
    assert not np.allclose(one.weights, mixed.weights)  # doc 1 counts as its mean label, 1/3


def test_quality_pairs_order_scores():
    rng = np.random.default_rng(1)
    good = rng.random(400) < 0.8
    x = rng.normal(size=(400, len(quality.FEATURES)))
    x[:, 3] += 3 * good
    model = quality.fit_pairs(x, good, np.ones(400))
    score = model.score(x)
    assert score[good].mean() > score[~good].mean() + 0.3
    assert abs((score < 0.3).mean() - (~good).mean()) < 0.02  # the quantile sets the cut


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = quality.score(docs, quality.Ranking()).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = quality.fit(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert quality.score(docs.limit(0), empty).count() == 0
    assert quality.fit_pairs(np.ones((3, len(quality.FEATURES))), np.array([True] * 3), np.ones(3)).score(np.ones((1, len(quality.FEATURES))))[0] == pytest.approx(0.3)


def test_language_held_out_accuracy(spark):
    docs = read(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.97


def test_language_distance_matches_definition():
    profiles = langid.Profiles({"aa": [1, 2, 3], "bb": [3, 2, 1]}, 3)
    keys, counts = np.array([1, 2, 9]), np.array([5, 4, 3])
    profiles_predict = langid.ngrams
    try:
        langid.ngrams = lambda text: (keys, counts)
        # aa: 0 + 0 + 3 (missing), bb: 2 + 0 + 3
        assert profiles.predict("x") == ("aa", pytest.approx(1 - 3 / 8))
    finally:
        langid.ngrams = profiles_predict


def test_numerals_are_no_letters(spark):
    profiles = langid.Profiles({"de": [97], "en": [98]}, 3)
    assert all(profiles.predict(t) == ("und", 0.0) for t in ("½ ²", "Ⅷ ½", "12 _ ٣", "", None, "😀"))
    assert langid._letters("½ab² c_d é1f") == ["ab", "c", "d", "é", "f"] and profiles.predict("a ½")[0] == "de"


def slow_grams(text):
    count = Counter()
    for w in re.findall(r"[a-zé]+", text.lower()):
        for size in (1, 2, 3):
            padded = w if size == 1 else f"_{w}_"
            count.update(padded[i : i + size] for i in range(len(padded) - size + 1))
    return count


def test_identification_is_the_definition():
    """Out-of-place distances by plain loops over n-grams as strings."""
    as_key = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    top = lambda t, n: [g for g, _ in sorted(slow_grams(t).items(), key=lambda x: (-x[1], as_key(x[0])))[:n]]
    learned = {"en": "the cat sat on the mat and the hat was there", "de": "die katze saß auf der matte und der hut war da", "fr": "le chat était sur le tapis et le chapeau aussi"}
    learned = {k: v.replace("ß", "s") for k, v in learned.items()}
    size = 40
    profiles = langid.Profiles({k: [as_key(g) for g in top(v, size)] for k, v in learned.items()}, size)
    for text in ("the hat", "der hut und die matte", "le tapis, le chat", "xyz the der le", "étaité"):
        own = top(text, size)
        apart = {k: sum(abs(i - top(v, size).index(g)) if g in top(v, size) else size for i, g in enumerate(own)) for k, v in learned.items()}
        near, far = sorted(apart.values())[:2]
        lang, score = profiles.predict(text)
        assert apart[lang] == near and score == pytest.approx(1 - near / (near + far))


def test_ngrams_in_pieces_equal_whole(monkeypatch):
    text = "The quick brown fox, 12 jumps over été " * 50
    whole = langid.ngrams(text)
    monkeypatch.setattr(langid, "_PIECE", 64)
    parts = langid.ngrams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    profiles = langid.fit(docs)
    rows = {(r.doc_id, r.lang_pred) for r in langid.identify(docs, profiles).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= rows and langid.identify(docs, profiles).count() == len(ODD)
    kept = langid.recognised(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == 4
    assert {r.lang for r in langid.recognised(docs, profiles, {"en"}, lang_col="lang").collect()} <= {"en"}
    assert langid.recognised(docs, profiles, least_score=1.1).count() == 0
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


@pytest.fixture(scope="module")
def model():
    return htmltext.train()


def test_extraction_on_composed_pages(model):
    dom = htmltext.Dom(labelled=True)
    for i in range(150):
        dom.add(i, htmltext.compose(880_000_000 + i))
    tree = htmltext.Tree(dom)
    words, truth = tree.own[:, 2], np.array(dom.marked)
    found = model.marginals(tree) >= 0.5
    shown = words > 0
    assert (found[shown] == truth[shown]).mean() > 0.97


def test_messages_match_enumeration():
    dom = htmltext.Dom()
    dom.add(0, "<div><p>a</p><ul><li>b</li></ul></div>")
    tree = htmltext.Tree(dom)
    rng = np.random.default_rng(3)
    unary, edge = rng.normal(size=tree.n), rng.normal(size=(len(htmltext._GROUPS), 2, 2))
    full, _, log_z = tree.messages(unary, edge)
    total, ones = 0.0, np.zeros(tree.n)
    for k in range(1 << tree.n):
        y = [(k >> i) & 1 for i in range(tree.n)]
        weight = np.exp(sum(unary[i] * y[i] for i in range(tree.n)) + sum(edge[tree.group[i]][y[tree.parent[i]], y[i]] for i in range(tree.n) if tree.parent[i] >= 0))
        total += weight
        ones += weight * np.array(y)
    assert log_z == pytest.approx(np.log(total))
    assert np.allclose(1 / (1 + np.exp(full[:, 0] - full[:, 1])), ones / total)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Site</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div><article><h1>A &amp; B</h1><p>First   para&shy;graph<br>goes on, here.<p>Of.<script>var x = "</p>";</script></article>
<aside class="sidebar"><h3>More</h3><p>Read this too, please do.</p></aside><section id="comments"><h3>Comments</h3><div class="comment"><p>I like it, very much so.</p></div></section>
<form><label>Mail</label><input><button>Join</button></form><div class="ad">Buy now, it is cheap.</div><footer>&copy; 2020 Site</footer></body></html>"""


def test_extraction_of_a_page(model):
    text = htmltext.main_texts([PAGE], model)[0]
    assert text == "A & B\n\nFirst para\xadgraph goes on, here.\n\nOf."


def page(body):
    return f"<html><body><nav><ul><li><a href=/a>One</a></ul></nav><article><h1>Some title of it</h1><p>First words of the article, they go on here.</p>{body}<p>Last words of the article, they end here.</p></article></body></html>"


@pytest.mark.parametrize(
    ("body", "shown"),
    [
        ("<div>" * 1000 + "<p>Deep words of text, here.</p>" + "</div>" * 1000, "Deep words of text, here."),
        ("<p>\ue000Mark in front of words, it stays.</p>", "\ue000Mark in front of words, it stays."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <svg><text>figure</text></svg> be <object>words</object>, say.</p>", "Let x=1 and figure be words, say."),
        ('<p>Seen words <span hidden>not seen</span> here, <b style="display: none">nor <i>this</i></b> now.</p>', "Seen words not seen here, nor this now."),
        ("<p hidden>Words that a script may show.</p>", "Words that a script may show."),
        ("<details><summary>Sum of it</summary>Detail words here.</details>", "Sum of it\n\nDetail words here."),
        ("<ul><li><a href=/a>First link words</a></li><li><a href=/b>Second link</a></li></ul>", "First link words\n\nSecond link"),
        ("<figure><img src=x><figcaption>A caption of the figure.</figcaption></figure>", "A caption of the figure."),
        ("<dl><dt>A</dt><dd>b</dd><dt>C</dt><dd>d</dd></dl>", "A\n\nb\n\nC\n\nd"),
        ("<section><h2>Part</h2><p>Words in a section.</p></section>", "Part\n\nWords in a section."),
        ("<p><a href=/x>A paragraph that is all link</a></p>", "A paragraph that is all link"),
        ("<p>It costs 3 < 4 and a <b title='a > b'>bold</b> word, see.</p>", "It costs 3 < 4 and a bold word, see."),
        ('<p data-hidden="x" title="hidden gem">Words that are not hidden, they show.</p>', "Words that are not hidden, they show."),
    ],
)
def test_nothing_of_the_article_is_lost(model, body, shown):
    assert htmltext.main_texts([page(body)], model)[0].split("\n\n") == ["Some title of it", "First words of the article, they go on here.", *shown.split("\n\n"), "Last words of the article, they end here."]


def test_hidden_text_can_be_left_out(model):
    text = htmltext.main_texts([page("<p hidden>Secret words of it, not shown.</p><div style='display:none'><p>More of them, not shown.</p></div><p>Seen words <span hidden>not shown</span>here.</p>")], model, keep_hidden=False)[0]
    assert "not shown" not in text and "Seen words here." in text and "Last words" in text


@pytest.mark.parametrize("html", ["<div>" * 20_000 + "<p>deep" + "</div>" * 20_000, "<a " * 350_000, "<!" * 500_000, '<a ">"' * 170_000, "<p" * 500_000, "<script>" * 130_000, "</p>" * 250_000, "<" * 1_000_000, "&" * 1_000_000, "<a href='" * 100_000, "<li><p>" * 20_000, "<a" * 500_000 + ">"])
def test_time_is_linear_in_a_page(html):
    began = time.perf_counter()
    dom = htmltext.Dom()
    dom.add(0, html)
    assert time.perf_counter() - began < 20


def test_extraction_odd_rows(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<", "x"), (4, "u", "<p>" * 3000 + "deep", "x"), (5, "u", "<!-- open", "x"), (6, "u", "<a href='x>y</a>", "x"), (6, "u", "<script>never closed", "x"), (None, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = htmltext.extract(pages, model).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.page_id in (1, 2, 5)] == ["", "", ""]
    assert htmltext.extract(pages.limit(0), model).count() == 0
