"""Quality classifier, mixing, fingerprints, page text and the pipeline."""

import html
import os
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from snapledger.llm import fingerprints as FP
from snapledger.llm import html_text, mixing, quality
from snapledger.llm.common import forget, row_keyed, written

SF001 = "/root/testdata/sf0.001"


# --- quality ---------------------------------------------------------------------


def rated(n: int, seed: int) -> list[tuple[int, str, int, int]]:
    """(id, text, quality, toxic): junk is shouted, toxic texts hold one of three words."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = cases.prose(rng, rng.randint(8, 60))
        kind = rng.choice([0, 1, 2, 2])
        if kind == 0:
            t += " " + rng.choice(["vermin", "oafish", "dolts"]) + " " + cases.prose(rng, 5)
        if kind == 1:
            t = " ".join(w.upper() + "!!" for w in t.split())
        out.append((i, t, int(kind != 1), int(kind == 0)))
    return out


def test_held_out_accuracy(spark):
    train, test = rated(600, 1), rated(300, 2)
    test = [(i + 1000, *r) for i, *r in test]
    docs = spark.createDataFrame([(i, t) for i, t, *_ in train + test], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in train], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == 900
    right = sum(got[i]["keep"] == (q == 1 and x == 0) for i, _, q, x in test)
    assert right >= 0.97 * len(test)
    mean = lambda rows: np.mean([got[r[0]]["expected_grade"] for r in rows])
    assert mean([r for r in test if r[3]]) < mean([r for r in test if not r[2]]) < mean([r for r in test if r[2] and not r[3]])


def test_features_reach_to_the_end_of_long_words():
    start = "abcdefgh" * 5
    for tail in ("poison", "x" * 300 + "poison"):
        a, b = quality.features(start + tail), quality.features(start + tail.replace("poison", "violet"))
        assert quality.hashed("p:pois") in a - b and quality.hashed("p:viol") in b - a
    # A text without spaces: each sequence of four signs counts wherever it stands.
    rng = random.Random(4)
    signs = [chr(c) for c in range(0x4E00, 0x4F00)]
    text = "".join(rng.choice(signs) for _ in range(5000))
    assert {quality.hashed(f"p:{text[i:i + 4]}") for i in range(len(text) - 3)} <= quality.features(text)
    table = quality.Words()
    table[text]
    assert not dict(table)  # long words aren't kept


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (4, None, None), (None, 0, 0), (7, 1, 0)]], ids=["none", "one grade"])
def test_quality_without_two_grades_keeps_all(spark, labels):
    docs = cases.table(spark, cases.rows())
    got = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(cases.rows()) and all(r["keep"] for r in got)


def test_ratings_take_the_worst(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, None), (4, None, 1), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert {r["key"]: r["grade"] for r in quality.ratings(labels).collect()} == {1: 1, 2: 0, 3: 2, 4: 0}


def test_one_text_of_a_repeated_key_is_fitted(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(500)] + [(2, "other"), (3, None), (4, "unrated")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda texts, grades, top: fitted.append((len(texts), grades)))
    quality.fit_on(docs, quality.ratings(labels))
    assert fitted == [(3, [2, 1, 0])]


def test_model_thresholds_ascend():
    rows = rated(200, 3)
    m = quality.fit([quality.packed(r[1]) for r in rows], [0 if r[3] else 1 + r[2] for r in rows], 2)
    assert m.thresholds[0] < m.thresholds[1]
    assert all(a >= b for a, b in [m.tails(r[1]) for r in rows])


# --- mixing -----------------------------------------------------------------------


@given(st.lists(st.integers(0, 60), min_size=1, max_size=8), st.integers(0, 120))
@settings(max_examples=150, deadline=None)
def test_sainte_lague_equals_dealing_one_by_one(population, seats):
    most = np.array([3 * p for p in population])
    want = np.zeros(len(population), int)
    for _ in range(seats):
        open_ = [(p / (2 * s + 1), -i) for i, (p, s) in enumerate(zip(population, want, strict=True)) if p > 0 and s < 3 * p]
        if not open_:
            break
        want[-max(open_)[1]] += 1
    assert mixing.sainte_lague(np.array(population), seats, most).tolist() == want.tolist()


def test_targets_share_all_and_stop_at_the_cap():
    t = mixing.targets([10, 1000, 500, 0], [5, 2, 1, 5])
    assert t[0] == 30 and t[3] == 0 and abs(t.sum() - 1510) < 1e-9 and abs(t[1] / t[2] - 2) < 1e-9
    assert mixing.targets([0, 0], [5, 2]).tolist() == [0, 0]


@pytest.mark.parametrize("shard_words", [1 << 17, 200])
def test_mix_comes_near_its_targets(spark, shard_words):
    data = cases.rows()
    docs = cases.table(spark, data)
    got = mixing.mix(docs, shard_words=shard_words, block_words=8, with_spans=True).collect()
    sizes = {s: 0 for s in ("books", "code", "web", None)}
    for d in data:
        sizes[d[2]] += len((d[1] or "").encode().split())
    target = dict(zip(sizes, mixing.targets(list(sizes.values()), [5, 2, 1, 5]), strict=True))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d[0], len((d[1] or "").encode().split())) for d in data)
    taken: Counter = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["times"] * r["size"] + sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2], strict=True))
        source = next(s for s, n in sizes.items() if n == r["source_size"])
        assert abs(r["target"] - target[source]) < 1e-6
        taken[source] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.03 * target[s] + 16
    again = mixing.mix(docs.repartition(5), shard_words=shard_words, block_words=8, with_spans=True).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(cases.table(spark, [])).count() == 0


# --- fingerprints --------------------------------------------------------------------


def test_fingerprint_is_a_homomorphic_multiset_hash():
    a = [b"one", b"two", b"two", b"three"]
    whole = FP.Fingerprint.of(a)
    assert whole == FP.Fingerprint.of(a[::-1]) != FP.Fingerprint.of(a[1:])
    assert whole == FP.Fingerprint.of(a[:2]) + FP.Fingerprint.of(a[2:])
    assert whole - FP.Fingerprint.of([b"two"]) == FP.Fingerprint.of([b"one", b"two", b"three"])
    assert FP.Fingerprint.parse(str(whole)) == whole
    assert FP.Fingerprint.of([]).likeness(FP.Fingerprint.of([])) == 1.0 and whole.likeness(FP.Fingerprint.of([])) == 0.0


def test_likeness_follows_the_share_of_common_paragraphs():
    for common in (0, 25, 50, 75, 90):
        a = [f"a{i}".encode() for i in range(100)]
        b = a[:common] + [f"b{i}".encode() for i in range(100 - common)]
        assert abs(FP.Fingerprint.of(a).likeness(FP.Fingerprint.of(b)) - common / 100) < 0.2


@pytest.mark.parametrize("data", [cases.rows(), cases.rows()[:1], []], ids=["rows", "one", "empty"])
def test_neighbour_fingerprints(spark, data):
    order = sorted(data, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    want = []
    for d, after in zip(order, [*order[1:], *order[:1]], strict=True):
        t, n = d[1] or "", after[1] or ""
        k = len(t) // 2
        e = t[:len(t) - k] + n[:k]
        f, g, h = (FP.Fingerprint.of_text(x) for x in (t, e, n))
        want.append((d[0], len(t), sha256(e.encode()).hexdigest(), str(f), str(g), f.likeness(g), f.likeness(h)))
    got = FP.neighbour_fingerprints(cases.table(spark, data)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert FP.fingerprints(cases.table(spark, data)).count() == len(data)


# --- pages ----------------------------------------------------------------------------


def page(rng: random.Random, i: int) -> tuple[int, str, str, str]:
    """A page without an article element: the site's furniture has no telling names."""
    blocks = [cases.prose(rng, rng.randint(5, 30)) + " & <b>" for _ in range(rng.randint(1, 5))]
    body = "".join(f"<p>{html.escape(b)}" for b in blocks)
    furniture = "<div class=x1><ul><li>Home<li>Shop<li>About us</ul></div>"
    foot = f"<div class=x2><p>Run by volunteers since 1999.</p><p>Page {i % 2}</p></div>"
    source = f"<html><head><title>t</title><style>p{{}}</style></head><body>{furniture}<div id=c{i}>{body}</div>{foot}<script>if (a<b) '<p>'</script><footer>f"
    return i, "http://one.example/" + str(i), source, "\n\n".join(" ".join(b.split()) for b in blocks)


def test_style_tree_cuts_what_a_site_repeats(spark):
    rng = random.Random(8)
    data = [page(rng, i) for i in range(40)]
    odd = [
        (100, "http://two.example/a", "<body><nav>menu</nav><article><h1>T</h1><p>a<b>x</b>y &nbsp; z<br>q<ul><li>1<li>2 &eacute;&#233;</ul><div class='comment-list'>no</div><form>f</form></article><aside>s</aside>",
         "T\n\naxy z q\n\n1\n\n2 éé"),
        (101, "http://two.example/a", None, ""), (101, None, "", ""), (None, "no url", "plain <unknown>text</unknown> &amp", "plain text &"),
        (102, "http://three.example", "<p>unclosed <b>bold<p>next</p></div>< not a tag <!-- <p>no</p> --> end", "unclosed bold\n\nnext\n\n< not a tag end"),
        (102, "http://three.example", "<table><tr><td>a<td>b<tr><td>c</table>" + "<p>" * 3000 + "deep", "a\n\nb\n\nc\n\ndeep"),
    ]
    rows = [(*r[:3], "clash") for r in data + odd]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert sorted((str(r["page_id"]), r["url"] or "", r["text"], r["n_chars"]) for r in got) == sorted((str(r[0]), r[1] or "", r[3], len(r[3])) for r in data + odd)
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copies_of_one_article_are_no_furniture(spark):
    """A host whose pages all hold the same article keeps it."""
    rows = [(i, "http://copies.example/" + str(i), "<body><div class=m><p>Same words on every page.</p><p>And these.</p></div></body>") for i in range(30)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Same words on every page.\n\nAnd these."}


@pytest.mark.parametrize("start", [
    "<div class='content no-sidebar'>", "<div id='page' class='has-banner'>", "<article class='post comments-open category-social'>",
    "<section class='aside-layout'>", "<div class='sidebar-left'>"])
def test_names_do_not_cut_the_whole_text(start):
    page = html_text.Page(f"<body><div class=menu>Home</div>{start}<h1>Title</h1><p>The words of the text.</p><div class='comment-list'>no</div>")
    assert page.main_text(frozenset()) == "Title\n\nThe words of the text."


def test_long_comments_beside_an_article_are_cut():
    page = html_text.Page("<article><p>Short text.</p></article><div id=comments>" + "<article class=comment><p>long remark</p></article>" * 20 + "</div>")
    assert page.main_text(frozenset()) == "Short text."


@pytest.mark.parametrize("body, want", [
    ("<main><p>The long text of the page stands here.</p><p>And goes on.</p><article class=card><p>Read next</p></article></main>",
     "The long text of the page stands here.\n\nAnd goes on.\n\nRead next"),
    ("<div><p>The long text of the page stands here.</p></div><article class=card><p>Read next</p></article>",
     "The long text of the page stands here.\n\nRead next"),
    ("<main><h1>Title</h1><p>Lead.</p><article><p>The long text of the page stands here.</p></article></main><p>outside</p>",
     "Title\n\nLead.\n\nThe long text of the page stands here.")])
def test_a_teaser_does_not_replace_the_text(body, want):
    assert html_text.Page(f"<body>{body}</body>").main_text(frozenset()) == want


def test_copies_with_a_line_of_their_own_keep_the_article(spark):
    words = "The same article stands on most pages of this host, with all its many words."
    rows = [(i, "http://copies.example/" + str(i), f"<body><div class=m><p>{words}</p></div><div class=f><p>Page {i}</p></div></body>") for i in range(30)]
    rows += [(100 + i, "http://copies.example/x", f"<body><div class=m><p>{cases.prose(random.Random(i), 30)}</p></div><div class=f><p>Page {i}</p></div></body>") for i in range(4)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(words in r["text"] for r in got if r["page_id"] < 100)


# --- the pipeline ------------------------------------------------------------------------


def test_forget_removes_what_was_written(spark):
    path = written(spark.range(3), "x").inputFiles()[0]
    forget(spark)
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_row_keyed_numbers_rows_by_key(spark):
    docs = cases.table(spark, cases.rows()).withColumn("__row", F.lit(1))
    rows, name = row_keyed(docs, "doc_id")
    got = sorted((r[name], r["doc_id"]) for r in rows.collect() if r["doc_id"] is not None)
    assert [k for _, k in got] == sorted(k for _, k in got) and len({n for n, _ in got}) == len(got)


@pytest.mark.parametrize("data", [cases.rows(), []], ids=["rows", "empty"])
def test_stages_take_awkward_rows(spark, data):
    docs = cases.table(spark, data)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF001), name)
        if name != "encoding":
            assert after.columns == docs.columns
        if name == "near_dedup":
            assert data == [] or 0 < after.count() < docs.count()
        if name == "suffix_dedup":
            assert after.count() == docs.count()
            assert after.where("n_chars <> length(text)").count() == 0
        docs = after
        sizes.append(docs.count())
    assert bool(sizes[-1]) == bool(data)


def test_stages_against_the_operators_on_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    first = written(corpus_pipeline.STAGES[0][1](spark, docs, SF001), "a")
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF001}/labels.parquet").where("toxic = 1 or quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF001}/labels.parquet").where("toxic = 0 and quality = 1").collect()}
    kept = {r["doc_id"] for r in first.select("doc_id").collect()}
    assert len(kept & good) >= 0.97 * len(good) and len(kept & bad) < len(bad)
    second = written(corpus_pipeline.STAGES[1][1](spark, first, SF001), "b")
    third = written(corpus_pipeline.STAGES[2][1](spark, second, SF001), "c")
    order = second.orderBy("doc_id").collect()
    raw = [(r["text"] or "").encode() for r in order]
    want = [bytes(np.frombuffer(b, np.uint8)[~g]).decode("utf-8", "ignore") for b, g in zip(raw, cases.repeats(raw, 100), strict=True)]
    assert [r["text"] for r in third.orderBy("doc_id").collect()] == want
    fourth = written(corpus_pipeline.STAGES[3][1](spark, third, SF001), "d")
    words = lambda t: len(t.encode().split())
    by: Counter = Counter()
    for r in third.collect():
        by[r["source"]] += words(r["text"])
    names = sorted(by)
    target = dict(zip(names, mixing.targets([by[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    mixed: Counter = Counter()
    for r in fourth.collect():
        mixed[r["source"]] += words(r["text"])
    assert all(abs(mixed[s] - target[s]) <= 0.1 * target[s] + 64 for s in names)
    assert corpus_pipeline.STAGES[4][1](spark, fourth, SF001).count() == fourth.count()
