"""Language identification, toxicity, main text and decontamination."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskflow.llm import decontamination, html_text, labelled_pages, langid, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(-1, None), (-2, ""), (-3, "123 ... !"), (-4, "«» — …"), (None, "the and of"), (-5, "x" * 100_000), (-5, "repeated"), (-5, "repeated")]


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def brute_probability(word, pieces, p):
    """The sum over all segmentations, each written out."""
    text, total = "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[last:i])
                last = i
        parts.append(text[last:])
        product = 1.0
        for part in parts:
            product *= p[pieces.index(part)] if part in pieces else (langid.UNKNOWN if len(part) == 1 else 0.0)
        total += product
    return total


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁t", "▁the", "t", "h", "e", "he", "th", "the", "n", "en"]
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces) + 1, 2))
    p[-1] = langid.UNKNOWN
    words = ["the", "then", "hen", "qt", "nnn", "e"]
    logs = langid.Lattice(pieces).forward(words, p)
    for w, row in zip(words, logs):
        assert row == pytest.approx([np.log(brute_probability(w, pieces, p[:, k])) for k in range(2)])
    # Expected counts: of each word's characters, all are covered.
    uses = langid.Lattice(pieces).expected(words, np.ones((len(words), 2)), p)
    lengths = np.array([*map(len, pieces), 1])
    assert (uses * lengths[:, None]).sum(axis=0) == pytest.approx([sum(len(w) + 1 for w in words)] * 2)


def test_languages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    unseen = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.filter(~unseen), PIECES, sample_per_language=100)
    assert model.languages == ["de", "en", "es", "fr"]
    assert model.probabilities[:-1].sum(axis=0) == pytest.approx([1] * 4)
    rows = langid.predict(docs.filter(unseen), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    odd = spark.createDataFrame([(d, t, "q") for d, t in ODD], "doc_id long, text string, score string")
    got = langid.predict(odd, model).collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, True, True, False, False, False, False]
    assert all(0 <= r["score"] <= 1 for r in got) and got[4]["lang_pred"] == "en"
    empty = langid.fit(docs.limit(0), PIECES)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(odd, empty).collect()} == {("und", 0.0)}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_held_out_rule(spark):
    import zlib

    got = [r["h"] for r in spark.range(300).select(langid.held_out(F.col("id"), 3, 1).alias("h")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300)]


def test_toxicity(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    unseen = langid.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.filter(~unseen))
    assert 0 < len(model.index) < 5_000
    rows = toxicity.score(docs.filter(unseen).join(labels, "doc_id"), model, 0.7).collect()
    flagged, toxic = [r for r in rows if r["predicted"]], [r for r in rows if r["toxic"] == 1]
    assert np.mean([r["toxic"] for r in flagged]) > 0.95
    assert np.mean([r["predicted"] for r in toxic]) > 0.6
    assert np.mean([r["score"] for r in toxic]) > np.mean([r["score"] for r in rows if r["toxic"] == 0]) + 0.5
    odd = spark.createDataFrame([(d, t, 5) for d, t in ODD], "doc_id long, text string, label int")
    got = toxicity.score(odd, model, 0.7).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got) and got[0]["score"] == got[1]["score"]
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, none, 0.7).collect()} == {0.5}


def test_ftrl_keeps_few_weights():
    rng = np.random.default_rng(0)
    examples = [(np.append(rng.choice(np.arange(10, 5000), 30, replace=False), np.full(i % 2, 7)), i % 2) for i in range(600)]
    model = toxicity.train(iter(examples), 5)
    weights = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert weights[7] > 2 and len(weights) < 200


def test_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>"</script></head><body>
      <nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>
      <div class="cookie-notice"><p>We use cookies on this site.</p><button>Fine</button></div>
      <article><h1>A &amp; B</h1><p>First  paragraph of\n the <b>text</b>, with some&nbsp;more words in it.<p>Second one&#8230;
      <div class="ad">Buy this now</div><ul><li>One point of the list.</li><li>Another point of it.</li></ul>
      <form><label>Mail</label><input name=q></form><!-- <p>hidden</p> --></article>
      <section id="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this text at all, sorry.</p></div></section>
      <aside class="sidebar"><h3>Most read</h3><a href="/1">Something else</a></aside><footer>&copy; 2020 All rights</footer></body></html>"""
    expected = "A & B\n\nFirst paragraph of the text, with some more words in it.\n\nSecond one…\n\nOne point of the list.\n\nAnother point of it."
    broken = ["<p", "<div><div><p>a", "</p></div>", "<script>", "plain text only, with a few words.", "<!--", "<a href='", "&#xD800; &bogus;"]
    rows = [(1, page), (2, None), (3, ""), (4, "<nav><a href='/'>x</a></nav>"), *((10 + i, b) for i, b in enumerate(broken))]
    pages = spark.createDataFrame([(i, h, "t", "q") for i, h in rows], "page_id long, html string, text string, _html string")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert html_text.extract(pages).columns == ["page_id", "_html", "text", "n_chars"]
    assert got[1]["text"] == expected and got[1]["n_chars"] == len(expected)
    assert [got[i]["text"] for i in (2, 3, 4)] == ["", "", ""] and len(got) == len(rows)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_text_in_and_after_embedded_elements():
    model = html_text.train(labelled_pages.labelled_pages())
    first, last = "The first paragraph of the text has some words in it.", "And this is what the last paragraph of it says."
    around = "<html><body><nav class='menu'><a href='/'>Home</a></nav>{}<article><h1>A title</h1><p>%s</p>{}<p>%s</p></article></body></html>" % (first, last)
    whole = f"A title\n\n{first}\n\n{last}"
    tags = "button select object canvas audio video svg math noscript template".split()
    for tag in tags:  # without an end tag nothing after it is lost, also if another one with an end tag follows
        assert html_text.main_text(around.format(f"<div class='header'><{tag} class=x></div>", ""), model) == whole, tag
        assert html_text.main_text(around.format("", f"<{tag}>"), model) == whole, tag
        assert last in html_text.main_text(around.format(f"<{tag}>", f"<{tag}></{tag}>"), model), tag
    for tag in "math svg object canvas audio video noscript".split():  # text of the article
        got = html_text.main_text(around.format("", f"<p>Here we have <{tag}><b>some more</b></{tag}> text in the article.</p>"), model)
        assert got == f"A title\n\n{first}\n\nHere we have some more text in the article.\n\n{last}", tag
    dropped = ["<button>Share</button>", "<select><option>One<option>Two</select>", "<template><p>{{ text }}</p><template></template></template>"]
    dropped += ["<script>x</script>", "<style>x</style>", "<textarea>x</textarea>", "<iframe>x</iframe>"]
    for other in dropped:
        assert html_text.main_text(around.format("", other), model) == whole, other
        got = html_text.main_text(around.format("", f"<p>Here we have {other} the text of the article.</p>"), model)
        assert got == f"A title\n\n{first}\n\nHere we have the text of the article.\n\n{last}", other
    assert [n.text for n in html_text.parse("<p>a <button>b <div>c</div> d</p>e") if n.text] == ["a", "b", "c", "d", "e"]


def test_main_text_of_unseen_pages():
    model = html_text.train(labelled_pages.labelled_pages())
    right = wrong = 0
    for seed in range(10_000, 10_150):
        nodes = html_text.parse(labelled_pages._Page(seed).html())
        labels = []
        for node in nodes:
            labels.append(node.label or (labels[node.parent] if node.parent >= 0 else ""))
        for node, label, p in zip(nodes, labels, html_text.marginals(nodes, model)):
            if node.text is not None:
                right += (p >= 0.5) == (label == "main")
                wrong += (p >= 0.5) != (label == "main")
    assert right > 60 * wrong


def test_messages_give_exact_marginals():
    model = html_text.train(labelled_pages.labelled_pages(60))
    nodes = html_text.parse("<body><div><p>Some words here.</p><ul><li>a</li><li><a href=1>b</a></li></ul></div></body>")
    total, main = 0.0, np.zeros(len(nodes))
    for states in itertools.product([0, 1], repeat=len(nodes)):
        p = model.root[states[0]]
        for i, (node, s) in enumerate(zip(nodes, states)):
            p *= np.exp(sum(model.weights[f][s] for f in node.features if f in model.weights))
            if i:
                p *= model.edges[states[node.parent]][s]
        total += p
        main += p * np.array(states)
    assert html_text.marginals(nodes, model) == pytest.approx((main / total).tolist())


def brute_contamination(docs, items, window):
    found = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = found(t)
        for a in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, ids = found(t), set(), set()
        for key, of in windows.items():
            for a in range(len(w) - len(key) + 1):
                if tuple(w[a : a + len(key)]) == key:
                    hit.update(range(a, a + len(key)))
                    ids |= of
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("part_words", [1, 10**6])
def test_contamination(spark, part_words, monkeypatch):
    monkeypatch.setattr(decontamination.with_matches, "__defaults__", (10, "text", "item_id", "text", part_words))
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab cd ef gh ij Kl mn öp".split()) + rng.choice(["", ",", "1"]) for _ in range(n))
    items = [(i, text(rng.randrange(12, 30))) for i in range(6)] + [(6, None), (7, ""), (8, "zz yy xx"), (9, "zz yy xx"), (None, "solo"), (11, text(200))]
    items.append((3, items[0][1]))
    docs = []
    for i in range(40):
        other = (rng.choice(items)[1] or "").split()
        docs.append((i, " ".join([text(rng.randrange(0, 40)), *(other[rng.randrange(4) :] if i % 3 else []), text(9)])))
    docs += [(100, None), (101, ""), (102, "ZZ-yy/xx ... solo"), (None, items[1][1]), (103, items[2][1]), (103, items[2][1]), (104, text(50_000))]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, matches int, n_words int, _text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination_report(frame, bench).drop("matches", "item_ids").collect()
    expected = brute_contamination(docs, items, 10)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    clean = decontamination.decontaminate(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(repr(r["doc_id"]) for r in clean.collect()) == sorted(repr(e[0]) for e in expected if not e[5])
    assert decontamination.decontaminate(frame, bench.limit(0)).count() == len(docs)
    assert decontamination.contamination_report(frame.limit(0), bench).count() == 0


def test_matches_are_maximal_and_located():
    item = [f"w{i}" for i in range(30)]
    tests = decontamination.test_suffixes([("a", " ".join(item))], 10)
    texts = ["x y " + " ".join(item[4:21]) + " z", " ".join(item[:9]), " ".join(item) + " " + " ".join(item[20:])]
    n_words, found = decontamination.ShardSearch(tests).find(pa.array(texts))
    assert n_words.tolist() == [20, 9, 40]
    assert sorted(map(tuple, found.tolist())) == [(0, 0, 4, 2, 17), (2, 0, 0, 0, 30), (2, 0, 20, 30, 10)]


def test_many_matches_of_equal_items():
    tests = decontamination.test_suffixes([(str(i), "Word") for i in range(100)], 10)
    begun = time.time()
    n_words, found = decontamination.ShardSearch(tests).find(pa.array(["x", "word " * 100_000, None]))
    matches, ids = decontamination._lists(found, 3, tests.items)
    assert time.time() - begun < 2
    assert n_words.tolist() == [1, 100_000, 0] and len(found) == 100_000
    assert [len(m) for m in matches.to_pylist()] == [0, 100_000, 0]
    assert ids.to_pylist() == [[], sorted(map(str, range(100))), []]


@pytest.mark.parametrize("unit", ["<a", "<a x", "<a title='", "<a t='>'", "<div>", "<!", "</script", "<script>", "<button>a<p>", "<template ", "<div><li>", "<td>"])
@pytest.mark.parametrize("end", ["", ">", "'>"])
def test_broken_markup_is_read_in_linear_time(unit, end):
    model = html_text.train(labelled_pages.labelled_pages(20))
    begun = time.time()
    html_text.main_text(unit * (400_000 // len(unit)) + end, model)
    assert time.time() - begun < 8


def test_unclosed_elements_and_end_tags():
    for opened, again in [("<div>", "</p>"), ("<div>", "<li>"), ("<div>", "<button>")]:
        begun = time.time()
        html_text.parse(opened * 40_000 + again * 40_000)
        assert time.time() - begun < 8


def test_tags_are_read_forward():
    texts = lambda page: [n.text for n in html_text.parse(page) if n.text]
    assert texts("<p title=it's>don't <b class='>'>stop</b>") == ["don't stop"]
    assert texts('<p title="a > b">in</p> 1 < 2 <a href="x') == ["in", '1 < 2 <a href="x']
    assert texts("<p a='x>y</p>z") == ["y", "z"]
    assert texts("<p>x &#" + "0" * 5000 + "65; &#" + "1" * 6000 + "; y") == ["x A \ufffd y"]


@pytest.mark.parametrize("most", [1, 7, 500])
def test_smallest_hashes(spark, most):
    rows = [(i // 2, "a" if i % 3 else "b") for i in range(900)] + [(5, "c")] * 30
    ids = spark.createDataFrame(rows, "_id long, lang string").withColumn("h", F.xxhash64("_id"))
    hashed = [(r["lang"], r["h"], r["_id"]) for r in ids.collect()]
    expected = [x for lang in "abc" for x in sorted(h for h in hashed if h[0] == lang)[:most]]
    got = langid.smallest_hashes(ids.drop("h"), most).withColumn("h", F.xxhash64("_id"))
    assert sorted((r["lang"], r["h"], r["_id"]) for r in got.collect()) == sorted(expected)
    assert langid.smallest_hashes(ids.drop("h").limit(0), most).count() == 0
