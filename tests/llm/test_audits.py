"""Filter audit, source divergence and decontamination: brute force and odd rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import decontaminate, divergence, filter_audit

FIELDS = "doc_id long, text string, lang string, source string, part string, mask int, n string, items string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", "z") for r in rows], FIELDS)


LONG = " ".join(f"word{k}" for k in range(4000))
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \n\x0b ", "", "a"), (4, LONG, "en", "b"), (5, LONG, "en", "b"), (5, LONG, "en", "b"), (None, LONG, "fr", None),
    (6, "SHOUT " * 120, "en", "a"), (7, "a # b", "en", "c"), (8, "ÜMLÄUT ümläut\x00 tail", "fr", "a"), (9, "word " * 99, "fr", "a"), (10, "a # b", "de", "c"), (10, "other", "de", "c"),
]


# --- filter interaction audit


def brute_audit(rows, labels):
    firsts = {}
    for i, t, *_ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    docs = []
    for i, t, lang, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > firsts[t],
        }
        said = [(q, x) for j, q, x in labels if j == i and i is not None]
        docs.append((lang or "", fails, any(q == 1 for q, _ in said), any(x == 1 for _, x in said)))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part, fails, good, bad in docs:
            left = next((s for s, f in enumerate(order, 1) if fails[f]), 6)
            for s, f in enumerate(order, 1):
                row = out.setdefault((part, order, s), [0] * 6)
                now = [left > s, left == s, fails[f] and left < s, fails[f] and sum(fails.values()) == 1, left == s and good, left == s and bad]
                out[part, order, s] = [a + b for a, b in zip(row, now, strict=True)]
                shapley[part, f] += left == s
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    labels = [(4, 1, 0), (4, 0, 1), (5, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (6, 0, 0)]
    known = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(documents(spark, ODD), known)
    rows = [tuple(r) for r in got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()]
    assert len(rows) == 4 * 600 and set(rows) == brute_audit(ODD, labels)
    assert filter_audit.audit(documents(spark, ODD).limit(0), known).count() == 0
    none = filter_audit.audit(documents(spark, ODD), known.limit(0))
    assert none.where("good_lost + toxic_lost > 0").count() == 0 and none.count() == 2400


def test_filter_audit_of_one_text(spark):
    """Copies that are most of the table: all but the least id fail E, in whatever task they are."""
    rows = [(k, "the same text", "en", "a") for k in range(3000)] + [(5000 + k, f"own {k}", "en", "a") for k in range(50)]
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(documents(spark, rows), labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got["removed"], got["kept"], got["good_lost"]) == (2999, 51, 1)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="AbZ é\n\t\x0b\x1c #|", max_size=400))
def test_text_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    want = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text))]
    assert filter_audit.text_mask(text.encode()) == sum(w << k for k, w in enumerate(want))


# --- source divergence audit


def brute_divergence(rows, least, most):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))) for _, t, lang, source in rows]
    df, n = Counter((lang, w) for lang, _, ws in docs for w in set(ws)), Counter((lang, s, w) for lang, s, ws in docs for w in ws)
    groups, out = {(lang, s) for lang, s, _ in docs}, set()
    for lang in {g[0] for g in groups}:
        kept, sources = [w for (k, w), c in df.items() if k == lang and c >= least], [s for k, s in groups if k == lang]

        def shares(count, kept=kept):
            total = sum(count(w) for w in kept)
            return {w: 1 + 1_000_000_000 * (count(w) + 5) // (total + 5 * len(kept)) for w in kept}

        p = {s: shares(lambda w, s=s: n[lang, s, w]) for s in sources}  # noqa: B023
        q = shares(lambda w: sum(n[lang, s, w] for s in sources))  # noqa: B023
        for s in sources:
            far = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            own = sorted((q[w] - p[s][w], w.encode()) for w in kept if n[lang, s, w] and p[s][w] > q[w])[:most]
            out |= {(lang, s, part, item.decode(), -v, k) for part, found in (("pair", far), ("term", own)) for k, (v, item) in enumerate(found, 1)}
    return out


def test_divergence(spark):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("Tea", "ÄÖ", "x1y", "of-the", "日本") for b in "abcdefgh"]
    rows = [(k, " ".join(words[int(w * len(words)) - 1] for w in rng.random(rng.integers(0, 40)) ** (1 + k % 3)), ["en", "fr", None, "none"][k % 17 % 4], [None, "a", "b", "rare"][int(rng.integers(0, 20)) % 4 if k % 9 else 3]) for k in range(300)]
    rows += [(500, "only here", "one source", "s"), *ODD]
    for least, most in ((3, 50), (30, 3)):
        got = divergence.audit(documents(spark, rows), least, most)
        found = [tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()]
        assert len(found) == len(set(found)) and set(found) == brute_divergence(rows, least, most)
    assert divergence.audit(documents(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError, match="least"):
        divergence.audit(documents(spark, rows), 256)


def test_sketch_never_underestimates(spark):
    """Also where many terms share a counter, and tasks hand on what they hold many times."""
    rng = np.random.default_rng(6)
    vocabulary = ["".join(map(chr, rng.integers(97, 123, 5))) for _ in range(3000)]
    rows = [(k, " ".join(vocabulary[int(3000 * w**3)] for w in rng.random(60)), "en", "a") for k in range(1500)]
    cells = divergence.sketch(documents(spark, rows).repartition(3), 200, 1 << 16, 500)
    df = Counter(w for _, t, *_ in rows for w in set(t.split()))
    estimates = cells[divergence.cells_of("en", [w.encode() for w in df], 1 << 16)].min(0)
    assert (estimates >= np.minimum(200, list(df.values()))).all()
    assert (estimates == np.minimum(200, list(df.values()))).mean() > 0.99
    counted = {r["term"]: r["n"] for r in divergence.counts(documents(spark, rows), 20).collect()}
    assert counted == {w: n for w, n in Counter(w for _, t, *_ in rows for w in t.split()).items() if df[w] >= 20}


# --- benchmark decontamination

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute_hits(text, items, width=10):
    words = re.findall(WORDS, lower(text))
    hit, names = set(), set()
    for item, t in items:
        of = re.findall(WORDS, lower(t))
        size = min(width, len(of))
        for a in range(len(of) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == of[a : a + size]:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        names.add(str(item))
    return len(words), len(hit), sorted(names), hit


PASSAGE = "The quick-brown FOX jumps; over 13 lazy dogs, and naïve Äpfel fall from the old tree into deep water below"
ITEMS = [(1, PASSAGE), (2, "short item"), (12, "Short  ITEM!"), (3, None), (4, "... ,,"), (None, "nameless words of some item that stands here once more again"), (5, PASSAGE.upper() + " and more of the same besides this"), (1, "another row of the first item with more than ten words in it")]
TEXTS = [
    *ODD,
    (20, f"before\n{PASSAGE.replace(' ', '...')}\nafter", "en", "a"),
    (21, " ".join(PASSAGE.split()[3:14]) + " short-item short item", "en", "a"),
    (22, " ".join(PASSAGE.split()[:8]) + " no more", "en", "a"),
    (23, "nameless words of some item that stands here once more again", "en", "a"),
    (24, f"Ünïcode 日本 {PASSAGE} {PASSAGE}", "en", "a"),
    (25, "w " * 30_000 + PASSAGE, "en", "a"),
]


@pytest.mark.parametrize("part_words", [200_000, 30])
def test_decontamination(spark, part_words):
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, doc_id string")
    got = decontaminate.find(documents(spark, TEXTS), items, part_words=part_words).collect()
    texts = defaultdict(list)
    for i, t, *_ in TEXTS:
        texts[i].append(t)
    want = sorted((i, *brute_hits(t, ITEMS)[:3]) for i, t, *_ in TEXTS if i is not None)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got if r["doc_id"] is not None) == want
    assert len(got) == len(TEXTS)
    for r in got:
        if r["spans"]:
            (t,) = texts[r["doc_id"]]
            within = [re.findall(WORDS, lower(t[s["start"] : s["end"]])) for s in r["spans"]]
            assert sum(map(len, within)) == r["n_hit"]
            assert all(not re.match(WORDS, lower(t[s["start"] - 1 : s["start"]])) and not re.match(WORDS, lower(t[s["end"] : s["end"] + 1])) for s in r["spans"])


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find(documents(spark, TEXTS).limit(0), items).count() == 0
    none = decontaminate.find(documents(spark, TEXTS), items.limit(0))
    assert none.count() == len(TEXTS) and none.where("n_hit > 0 OR size(items) > 0 OR size(spans) > 0").count() == 0


def test_pieces_have_the_windows_of_the_item(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 25)
    text = " ".join(f"w{k}" for k in range(203))
    items = spark.createDataFrame([(1, text), (1, text), (2, " ".join(f"w{k}" for k in range(25)))], "item_id long, text string")
    rows = decontaminate._pieces(items, 10).collect()
    windows = {bytes(r["words"]).split()[a] for r in rows if r["item"] == "1" for a in range(r["size"] - 9)}
    assert windows == {f"w{k}".encode() for k in range(194)} and max(r["size"] for r in rows) == 25


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("a b c D".split()), max_size=14), st.lists(st.lists(st.sampled_from("a b c d".split()), max_size=5), max_size=4))
def test_scan(text, items):
    windows = decontaminate.Windows([(str(k), [w.encode() for w in x]) for k, x in enumerate(items)], 3)
    words = decontaminate.words_of(" ".join(text).encode())
    runs, names = windows.scan(words)
    _, n, want, hit = brute_hits(" ".join(text), [(k, " ".join(x)) for k, x in enumerate(items)], 3)
    assert {k for a, b in runs for k in range(a, b)} == hit and sum(b - a for a, b in runs) == n and sorted(names) == want
