"""Line dedup, mixing, classifiers and HTML: brute force, held-out accuracy and odd rows."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import common, html_main, line_dedup, mixing, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
FIELDS = "doc_id long, text string, source string, size string, score string, n_lines string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], FIELDS)


ODD = [(1, None, "a"), (2, "", None), (3, "  \n\n ", "a"), (4, "word " * 3000, "b"), (5, "word " * 3000, "b"), (5, "word " * 3000, "b"), (None, "lost", "c"), (7, "ümläut\x00\x0b tail", None)]


# --- line dedup


def brute_lines(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        gone = [i is not None and len(holders.get(key(x), ())) >= 3 and i != max(holders[key(x)]) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    line = "A Line that many documents hold"
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\nshort\nshort", "s") for i in range(6)] + [(9, f"{line}\n{line}", "s"), (10, "only two of these lines here\nx", "s"), (11, "only two of these lines here", "s"), *ODD]
    got = line_dedup.drop_repeated_lines(documents(spark, rows))
    assert {"size", "score", "source"} <= set(got.columns)
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=str) == brute_lines(rows)
    assert line_dedup.drop_repeated_lines(documents(spark, []).limit(0)).count() == 0
    kept = line_dedup.drop_repeated_lines(documents(spark, rows), counts=False)
    assert {r["n_lines"] for r in kept.select("n_lines").collect()} == {"z"}


def test_line_dedup_of_long_documents(spark):
    """Work grows with a document's lines, not with their square."""
    body = "\n".join(f"line number {k} is repeated in all of them" for k in range(60_000))
    rows = [(i, body, "s") for i in range(4)] + [(1, body + "\nits own", "s")]
    began = time.time()
    got = {(r["doc_id"], r["n_lines"]): (r["n_dropped"], len(r["text"])) for r in line_dedup.drop_repeated_lines(documents(spark, rows)).collect()}
    assert got == {(0, 60_000): (60_000, 0), (1, 60_000): (60_000, 0), (1, 60_001): (60_000, 7), (2, 60_000): (60_000, 0), (3, 60_000): (0, len(body))}
    assert time.time() - began < 60


# --- mixing


def test_mixing(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 60)), "abcd"[min(3, int(rng.exponential(0.7)))]) for i in range(3000)] + ODD
    got = mixing.mix(documents(spark, rows)).collect()
    again = mixing.mix(documents(spark, rows[::-1])).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["mark"], r["times"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(rows)
    total, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r["times"] <= 3
        total[r["source"]] += r["times"] * r["size"]
        target[r["source"]] = r["target"]
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows)
    assert sum(target.values()) == pytest.approx(words)
    # the level by bisection
    size = {r["source"]: r["source_size"] for r in got}
    names = sorted(size, key=lambda s: (s is None, s))
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(level * (k % 3 + 1), 3 * size[s]) for k, s in enumerate(names)) < words else (low, level)
    for k, s in enumerate(names):
        assert target[s] == pytest.approx(min(level * (k % 3 + 1), 3 * size[s]), rel=1e-6, abs=1e-3)
        assert abs(total[s] - target[s]) <= 3100
    assert mixing.mix(documents(spark, []).limit(0)).count() == 0
    assert mixing.mix(documents(spark, ODD[:3])).where("times > 0").count() == 0
    mixed = mixing.mixed_documents(documents(spark, rows))
    assert mixed.columns == documents(spark, rows).columns
    assert mixed.count() == sum(r["times"] for r in got)


def test_mixing_serves_a_plain_queue(spark):
    """What is taken is the merged sequence of all sources' queues, cut at the budget, entry for entry."""
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(0, 50)), "abcd"[min(3, int(rng.exponential(0.6)))]) for i in range(1500)] + ODD
    docs = documents(spark, rows)
    entries: dict = defaultdict(int)
    for r in mixing.queue(docs, 7).collect():
        entries[r["doc_id"], r["source"], r["mark"], r["size"], r["u"]] += 1
    sources = sorted({e[1] for e in entries}, key=lambda s: (s is None, s))
    place = lambda e: (e[0] is not None, e[0] or 0, e[2], e[3])
    sequence, budget = [], sum(e[3] * n for e, n in entries.items())
    for k, source in enumerate(sources):
        own = sorted((e for e in entries if e[1] == source), key=lambda e: (e[4], *place(e)))
        size = sum(e[3] * entries[e] for e in own)
        for epoch in range(3):
            upto = 0
            for e in own:
                words = e[3] * entries[e]
                upto += words
                if words:
                    sequence.append(((epoch * size + upto - words / 2) / (k % 3 + 1), k, place(e), words, e))
    times: dict = defaultdict(int)
    run = 0
    for _, _, _, words, e in sorted(sequence, key=lambda x: x[:3]):
        run += words
        if run > budget:
            break
        times[e[:4]] += 1
    got = {(r["doc_id"], r["source"], r["mark"], r["size"]): r["times"] for r in mixing.plan(docs).collect()}
    assert got == {e[:4]: times[e[:4]] for e in entries}


# --- classifiers


@pytest.mark.parametrize(("name", "label", "fold", "least"), [("op1_quality", "quality", (3, 1), 0.95), ("op9_toxicity", "toxic", (5, 0), 0.9)])
def test_held_out_accuracy(spark, name, label, fold, least):
    scored = queries.queries()[name](spark, SF).toPandas()
    assert scored["doc_id"].is_unique and scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.5)).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % fold[0] == fold[1]) for i, h in zip(scored["doc_id"], scored["held_out"], strict=True))
    held = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held[label]).mean() >= least


TRAIN = [("the plain words stand here and there", 0), ("some other words of the day are fine", 0), ("you are an idiot and more", 1), ("what an idiot he is today", 1), ("idiot is not a nice word", 1), ("well this is good news", 0)] * 8
SYLLABLES = "ka lo mi ten ras pou vel dri son gat".split()
TRAIN = [(" ".join([t, *("".join(np.random.default_rng([k, j]).choice(SYLLABLES, 3)) for j in range(8))]), v) for k, (t, v) in enumerate(TRAIN)]


def test_toxicity_tolerates_marks_and_gaps(spark):
    model = toxicity.train([t for t, _ in TRAIN], [v for _, v in TRAIN])
    value = lambda text: float(model.probability(np.array([max(model.values([w for t in toxicity.tokens_of(text) for w in toxicity.words_of(t)]), default=model.bias)]))[0])
    for text in ("an IDIOT!!", "an i.d.i.o.t", "an id-iot", "an i d i o t", "an id1ot", "an idiiot"):
        assert value(text) > 0.5, text
    for text in ("the plain words", "good news", ""):
        assert value(text) < 0.5, text


def document_value(model, text):
    return float(model.probability(np.array([max(model.values([w for t in toxicity.tokens_of(text) for w in toxicity.words_of(t)]), default=model.bias)]))[0])


def test_toxicity_of_long_and_broken_tokens():
    model = toxicity.train([t for t, _ in TRAIN], [v for _, v in TRAIN])
    for text in ("abcdefghij." * 5 + "i.d.i.o.t", ".".join("idiot" * 12), " ".join("idiot" * 12), "x" * 300 + " idiot", "plainwords.and.more." * 20 + "idiot"):
        assert document_value(model, text) > 0.5, text
    for text in ("abcdefghij." * 30, "www.plain-words.example.org/of/the/day"):
        assert document_value(model, text) < 0.5, text


@pytest.mark.parametrize(("insult", "clean"), [("идиот", "какой хороший день сегодня и завтра"), ("ηλίθιε", "τι ωραία μέρα που είναι σήμερα"), ("바보멍청이", "오늘은 정말 좋은 날이에요")])
def test_toxicity_in_any_script(insult, clean):
    texts = [(f"{t.replace('idiot', insult)} {clean.split()[k % 3]}", v) for k, (t, v) in enumerate(TRAIN)]
    model = toxicity.train([t for t, _ in texts], [v for _, v in texts])
    assert document_value(model, f"{clean} {insult}!") > 0.5 > document_value(model, clean)
    assert document_value(model, ".".join(insult)) > 0.5


def test_rare_insults_become_landmarks():
    """Three bags of a small language tell a word, among hundreds of toxic ones; a chance word of as many doesn't pass."""
    rng = np.random.default_rng(3)
    filler = [f"^{''.join(rng.choice(SYLLABLES, 4))}$" for _ in range(5000)]
    draw = lambda: set(rng.choice(filler, 20))
    toxic = [draw() | {"^idiot$"} for _ in range(400)] + [draw() | {"^tonto$"} for _ in range(4)]
    clean = toxicity.Counter(w for _ in range(1500) for w in draw())
    chosen = toxicity.choose_landmarks(toxic, clean, 96)
    assert "^tonto$" not in chosen and toxicity.rare_landmarks(toxic, clean, 1500, chosen, 96) == ["^tonto$"]


def test_training_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 50, f"text {i} " * 20) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 1)], "doc_id long, toxic int")
    got = common.labelled_sample(docs, labels, "toxic", {0: 10, 1: 15}, 1)
    assert got["label"].value_counts().to_dict() == {0: 10, 1: 15} and got["doc_id"].is_unique
    monkeypatch.setattr(common, "SAMPLE_CHARS", 1000)
    few = common.labelled_sample(docs, labels, "toxic", {0: 10, 1: 15}, 1)
    assert 0 < few["text"].str.len().sum() <= 1000
    assert len(common.labelled_sample(docs.limit(0), labels, "toxic", {0: 10}, 1)) == 0


def test_string_kernel_against_definition():
    def slow(a, b):
        total = 0.0
        for x, wx in subsequences(a):
            for y, wy in subsequences(b):
                total += wx * wy * (x == y)
        return total

    def subsequences(s):
        d, n = toxicity.DECAY, len(s)
        return [(s[i] + s[j] + s[k], d ** (k - i + 1)) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, n) if k - i < toxicity.SPAN]

    words, marks = ["^idiot$", "^idxiot$", "^plain$", "^aaaa$"], ["^idiot$", "^aaa$"]
    got = toxicity.kernel(toxicity.Alphabet(marks + words), words, marks)
    expected = [[slow(w, m) / slow(m, m) for m in marks] for w in words]
    assert np.allclose(got, expected)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcdé$^1", min_size=1, max_size=30), min_size=1, max_size=8), st.integers(0, 1000))
def test_scores_by_subsequence_are_the_machine_on_kernel_values(words, seed):
    marks = ["^idiot$", "^aaa$", "^abcd", "^dé$"]
    share = np.random.default_rng(seed).normal(size=len(marks))
    alphabet = toxicity.Alphabet(marks)
    model = toxicity.Model(alphabet, toxicity._by_subsequence(alphabet, marks, share), 0.25, 1.0, 0.0)
    assert np.allclose(model.values(words), toxicity.kernel(alphabet, words, marks) @ share + 0.25)


def test_quality_against_a_plain_version():
    rng = np.random.default_rng(2)
    good, bad = "The river runs past old mills and quiet fields .".split(), "buy NOW !!! click click 100 $$$ here x9".split()
    labels = [int(k % 3 > 0) for k in range(90)]
    texts = [" ".join(rng.choice(good if rng.random() < 0.9 else bad, 25) if v else rng.choice(bad, 25)) for v in labels]
    model = quality.train(texts, labels)
    vectors, network = model.vectors, model.network
    names = list(vectors.number)
    of = lambda w: vectors.number.get(w, vectors.number.get(quality.shape(w), 1))
    # random indexing: a word's own vector and, at unit length, the sum of its neighbours' by their distance
    own = quality.index_vectors(names)
    context = np.zeros(own.shape)
    for text in texts:
        ids = [of(w) for w in quality.words_of(text)]
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if 0 < abs(i - j) <= quality.WINDOW:
                    context[a] += own[b] / abs(i - j)
    length = np.linalg.norm(context, axis=1, keepdims=True)
    assert np.allclose(vectors.table, own / np.sqrt(quality.ONES) + context / np.maximum(length, 1e-6), atol=1e-4)
    # pooling and both layers, word by word and unit by unit
    a, b, c, d = network.parts
    for text in [*texts[:6], "", None, "one", "again again again other"]:
        words = quality.words_of(text)
        x = np.zeros(2 * quality.SIZE + 4)
        x[-1] = np.log1p(len(words)) / 5
        if words:
            rows = np.array([vectors.table[of(w)] for w in words], np.float64)
            again = sum(v == w for v, w in zip(words, words[1:], strict=False))
            x[: quality.SIZE] = (rows.sum(0) + again * vectors.table[0]) / (len(words) + again)
            x[quality.SIZE : -4] = rows.std(0)
            x[-4:-1] = again / len(words), len(set(words)) / len(words), max(map(words.count, words)) / len(words)
        assert np.allclose(vectors.pooled([text])[0], x, atol=2e-3)
        z = (vectors.pooled([text])[0].astype(np.float64) - network.mean) / network.scale
        logit = sum(np.tanh(sum(z * a[:, k]) + b[k]) * c[k] for k in range(len(c))) + d[0]
        assert model.score([text])[0] == pytest.approx(1 / (1 + np.exp(-np.clip(logit / network.temperature, -30, 30))), abs=1e-6)
    # no temperature of the grid has less loss on the documents given
    x, y = vectors.pooled(texts).astype(np.float64), np.array(labels)
    network.calibrate(x, y)
    chosen = network.temperature

    def loss(t):
        network.temperature = t
        p = network.probability(x)
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    assert loss(chosen) <= min(map(loss, np.geomspace(0.25, 16, 121))) + 1e-9


@pytest.mark.parametrize(("module", "empty"), [(toxicity, 0.0), (quality, 0.5)])
def test_classifiers_on_odd_rows(spark, module, empty):
    docs = documents(spark, ODD)
    assert {r["score"] for r in module.score(docs, None).collect()} == {empty}
    model = module.train([t for t, _ in TRAIN], [v for _, v in TRAIN])
    got = module.score(docs, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert module.score(docs.limit(0), model).count() == 0
    assert module.train(["a"], [1]) is None
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int").selectExpr("*", "toxic as quality")
    assert module.fit(docs, labels, labels.doc_id > 0) is None


# --- HTML


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/">home</a></li></ul></nav><div id="cookie-notice">We use cookies here, and here is a long text on them all.</div>
%s<aside>Other things to read, with many more words than one would think at first sight.</aside>
<section id="comments"><p>A reader has a long opinion on all of this, and says so at length, again and again.</p></section><form><p>Sign up now</p></form><footer>&copy; 2020</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="post-content">%s</div>', "<div><div>%s</div></div>", "%s"])
def test_main_text(wrap):
    body = "<h2>Real &amp; title</h2><p>The first block\n has <b>enough</b> words to be the main text of this page.<br>And more.<p>Short.</p><div class='ad-box'>Buy now!</div><!-- x --><p>The last block also has some words&nbsp;in it, &lt;tag&gt; included.</p>"
    expected = ["Real & title", "The first block has enough words to be the main text of this page. And more.", "Short.", "The last block also has some words in it, <tag> included."]
    assert html_main.main_text(PAGE % (wrap % body)) == "\n\n".join(expected)


def test_main_text_odd():
    assert [html_main.main_text(p) for p in (None, "", "<p></p>", "plain", "<p>a<p>b", "<div", "</div></p>x")] == ["", "", "", "plain", "a\n\nb", "<div", "x"]
    long = "<article>" + "<p>" + "word " * 200_000 + "</p></article>"
    assert len(html_main.main_text(long)) == 5 * 200_000 - 1


LEDE, BODY = "This lede says in a few words what the story is about, and is long enough to be seen as such.", "The story itself goes on for quite a while here. " * 24
NEST = f'<div itemprop="articleBody"><p>{BODY}</p></div>'


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f'<div class="post"><p>{LEDE}</p><div><p>{BODY}</p></div></div>', [LEDE, BODY]),
        (f"<div><p>Before.</p><ul><li>{BODY}<li>{BODY}</ul><p>After.</p></div>", ["Before.", BODY, BODY, "After."]),
        (f"<div><p>Before.</p><blockquote>{BODY}</blockquote><p>After.</p></div>", ["Before.", BODY, "After."]),
        (f"<div><p>Before.</p><table><tr><td>{BODY}<td>{BODY}</table><p>After.</p></div>", ["Before.", BODY, BODY, "After."]),
        (f"<div><p>Before.</p><section>{BODY}</section><p>After.</p></div>", ["Before.", BODY, "After."]),
        (f"<article><p>{LEDE}</p>{NEST}</article>", [LEDE, BODY]),
        (f"<article><p>{LEDE}</p><article><p>{BODY}</p></article></article>", [LEDE, BODY]),
        *((f"<article><p>{LEDE}</p>{x}<p>{BODY}</p></article>", [LEDE, BODY]) for x in ('<svg width="1" />', "<math/>", "<select>", "<object data=x>", "<title>", "<iframe />")),
        (f"<article><select><p>{LEDE}</p><select><option>no</select><p>{BODY}</p></article>", [LEDE, BODY]),
        (f"<article><p>{LEDE}</p><svg><svg><text>no</text></svg><text>no</text></svg><p>{BODY}</p></article>", [LEDE, BODY]),
        (f"<article><p>{BODY} <math><mi>x</mi><annotation>no</annotation></math></p></article>", [BODY + " x"]),
    ],
)
def test_main_text_is_whole(page, expected):
    assert html_main.main_text(f"<html><body>{page}<footer>No.</footer></body></html>") == "\n\n".join(" ".join(x.split()) for x in expected)


STORY = " ".join(["The story itself goes on for quite a while here and says much."] * 6)


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f'<div class="overflow-hidden"><p>{STORY}</p></div>', [STORY]),
        (f'<div class="content-with-sidebar"><p>{STORY}</p></div>', [STORY]),
        (f'<article title="The hidden valley"><p>{STORY}</p></article>', [STORY]),
        (f'<div data-hidden="false"><p>{STORY}</p></div>', [STORY]),
        (f'<div data-id="comments"><p>{STORY}</p></div>', [STORY]),
        (f'<div><p>{STORY}</p><p class="alert-level">Level two holds.</p><p>{STORY}</p></div>', [STORY, "Level two holds.", STORY]),
        (f"<div><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><div><h1>Title</h1><p>{STORY}</p></div><div>Copyright 2020 Example</div>", ["Title", STORY]),
        (f"<ul><li>Home<li>News</ul><h1>Title</h1><p>{STORY}</p><p>Copyright 2020 Example</p>", ["Title", STORY]),
        (f"<div id=page><div>Home News Sport</div><h1>Title</h1><p>{STORY}</p><p>Short.</p><p>{STORY}</p><div>Copyright 2020</div></div>", ["Title", STORY, "Short.", STORY]),
        (f"<form id=aspnet><div>Home</div><div class=post><p>{STORY}</p></div></form>", [STORY]),
        (f"<div class=notice><article><p>{STORY}</p></article></div><p>Short.</p>", [STORY]),
        (f'<div class="post"><p>{STORY}</p><div class="share-buttons">Tell all of your friends</div><section id="comments"><p>{STORY}</p><p>{STORY}</p></section></div>', [STORY]),
        (f'<div class="left-sidebar"><p>{LEDE}</p></div><div><p>{STORY}</p></div>', [STORY]),
        (f'<article><p title="a > b">{STORY}</p><p class=x href=a"b>{STORY}</p><p {STORY}</p></article>', [STORY, STORY]),
    ],
)
def test_markup_only_weighs(page, expected):
    assert html_main.main_text(f"<html><body>{page}</body></html>") == "\n\n".join(expected)


ARTICLE = f"<h1>Title of it</h1><p>{LEDE}</p><p>Some more of it follows.</p>"
COMMENT = "<div class=i><p>A reader says so.</p><a href=#>Reply</a></div>"


@pytest.mark.parametrize("times", [0, 2, 20, 100, 1000])
@pytest.mark.parametrize("wrap", ["main", "article", "div", "div class=post"])
def test_boxes_of_any_size_stay_out(wrap, times):
    """What is no article stays out, be it a hundred times as long."""
    side = "".join(f"<p>Other words number {k}, many of them and in whole sentences.</p>" for k in range(times))
    heads = ("3 Comments", "Kommentare (4)", "Laisser un commentaire", "Comentarios")
    boxes = [f"<{b}>{side}</{b.split()[0]}>" for b in ("footer", "form", "aside", "div class=sidebar", "div class=related", "div class=ad-box", "div hidden")]
    boxes += [f"<div class=discussion><h3>{h}</h3>{side}</div>" for h in heads] + [f"<h2>{heads[0]}</h2>{side}", f"<div class=talk>{COMMENT * 3}{side}</div>"]
    end = ("© 2024 Us", "2024 Wir. Alle Rechte vorbehalten", "Nous, tous droits réservés", "Todos los derechos reservados")
    for k, box in enumerate(boxes):
        page = f"<html><body><nav><a href=/>Home</a></nav><{wrap}>{ARTICLE}</{wrap.split()[0]}>{box}<div>{end[k % 4]}</div></body></html>"
        assert html_main.main_text(page) == "\n\n".join(["Title of it", " ".join(LEDE.split()), "Some more of it follows."]), box[:60]


def test_what_looks_like_comments():
    """Headings and links that only look like those of readers' comments, or have the article in their box."""
    for page in (f"<main><h1>Comments</h1><p>{STORY}</p></main>", f"<article><h1>Discussion of results</h1><p>{STORY}</p><p>Reply</p></article>"):
        assert STORY in html_main.main_text(page)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 30), st.integers(0, 400)), max_size=14))
def test_surge_and_dive_by_hand(weights):
    n = html_main.WINDOW
    before, after = [sum(weights[max(0, k - n + 1) : k + 1]) for k in range(len(weights))], [sum(weights[k : k + n]) for k in range(len(weights))]
    ground = min(max(before, default=0) // 10, 80)
    up = [a > ground and b > ground for a, b in zip(before, after, strict=True)]
    spans = [(a, b) for a in range(len(up)) for b in range(a, len(up)) if all(up[a : b + 1])]
    expected = max(spans, key=lambda s: (sum(weights[s[0] : s[1] + 1]), s[1] - s[0], -s[0]), default=None) or ((weights.index(max(weights)),) * 2 if any(weights) else (0, -1))
    assert html_main.core(np.array(weights, np.int64)) == expected


@pytest.mark.parametrize("part", ["<a", "<a '", '<a x="', "<div>x", "</p>", "<title>", "<iframe><title>", "<svg>", "<p class='", "</section><div>", "<!--", "<body><div>", "<script>", "<", "<p class=ad>x"])
def test_broken_markup_takes_linear_time(part):
    began = time.process_time()
    html_main.main_text(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 8  # quadratic time would be hours


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<nav>", "</nav>", "text ", "&amp;", "<br>", "<", ">", "<!--", "-->", "<script>"]), max_size=25))
def test_main_text_never_fails(parts):
    assert isinstance(html_main.main_text("".join(parts)), str)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE % "<article><p>Hello there, world.</p></article>", 5), (1, None, None, 6)], "page_id long, url string, html string, text int")
    assert [(r["page_id"], r["text"]) for r in html_main.extract(pages).collect()] == [(1, "Hello there, world."), (1, "")]
    got = queries.op10_html_extraction(spark, SF).collect()
    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got:  # these pages hold their text in article elements
        inner = re.search(r"<article>(.*)</article>", raw[r["page_id"]], re.S)[1]
        bare = re.sub(r"<[^>]+>", " ", inner)
        assert "".join(__import__("html").unescape(bare).split()) == "".join(r["text"].split())


def test_digest_matches_text(spark):
    rows = [(1, "a\nb", "s"), (2, None, "s")]
    docs = documents(spark, rows)
    got = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got[2] == hashlib.sha256(b"").hexdigest()
