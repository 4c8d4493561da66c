import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daylake.llm import decontaminate, features, html_extract, langid, quality, queries
from daylake.llm.common import crc_mod, slices

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>No &lt;</title><style>p{}</style><script>var a="</p><article>x</article>";</script></head>
<body class="has-sidebar"><div id="siteHeader">Site</div><header><h1>Logo</h1></header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">We use cookies</div>%s<aside>Aside</aside><section id="comments"><p>%s</p></section>
<form><p>Search</p></form><footer>&copy; foot</footer></body></html>"""
BODY = """<h2>Title &amp; more</h2><p>First   para <b>bold</b>text
 and&nbsp;so<p>Second &eacute;&#233;&#x41; <i>x</i> 1 < 2</p><div class="ad">Buy</div><ul><li>one<li>two</ul><!-- c <p>no</p> --><p>End."""
TEXT = "Title & more\nFirst para boldtext and so\nSecond ééA x 1 < 2\none\ntwo\nEnd."


@pytest.mark.parametrize("wrap", ["<article><header>Head</header>%s</article>", "<main>%s</main>", "<div role='main'>%s</div>"])
def test_marked_article(wrap):
    want = ("Head\n" if "header" in wrap else "") + TEXT
    assert html_extract.main_text(PAGE % (wrap % BODY, "long reader comment " * 50)) == want


def test_unmarked_article_by_line_blocks():
    assert html_extract.main_text(PAGE % (f"<div class='content'>{BODY}</div>", "reader " * 80)) == TEXT
    far = "<p>tiny</p>" + "<div class='ad'>x</div>" * 4 + "".join(f"<p>{'word ' * 30}{k}</p>" for k in range(5))
    # nothing but furniture goes, however short a stretch is
    assert html_extract.main_text(far).startswith("tiny\nword") and html_extract.main_text(far).count("\n") == 5


def test_names_that_only_mention_furniture():
    text = "<p>Real <button>Share</button>text <span class='hidden'>no</span>here.</p><p>And more of it.</p>"
    want = "Real text here.\nAnd more of it."
    for wrap in ("<div class='has-sidebar wide'>%s</div>", "<div id='no-comments'>%s</div>", "<div class='sidebar-layout'>%s</div>",
                 "<article><div class='entry-header'>%s</div></article>"):
        assert html_extract.main_text(f"<body><nav>menu</nav>{wrap % text}<footer>f</footer></body>") == want


def test_unmarked_page_keeps_short_stretches_beside_furniture():
    bar = "<div class='share'>x</div>" * 4
    body = "".join(f"<p>{'word ' * 200}{k}.</p>" for k in range(5))
    text = html_extract.main_text(f"<body><nav>menu</nav><h1>Berlin</h1>{bar}<p>A short lead.</p>{bar}{body}{bar}<p>The end</p>"
                                  f"<p>Done.</p>{bar}<p><a href='?p'>Print</a></p>{bar}<footer>f</footer></body>").split("\n")
    assert text[:2] == ["Berlin", "A short lead."] and text[-2:] == ["The end", "Done."] and len(text) == 9
    last = html_extract.main_text(f"<body><h1>Prayer</h1><p>{'word ' * 200}</p>{'<nav>x</nav>' * 3}<p>Amen</p></body>")
    assert last.split("\n")[::2] == ["Prayer", "Amen"]


SLUGS = """<h2 id="how-to-search-and-replace">Search and replace</h2><p>All of it.</p><section id="discussion"><h2>Discussion</h2>
<p>What it means.</p></section><section id="related-work"><h3 id="a-follow-up">A follow-up</h3><p>What others did.</p></section>
<div class="section" id="related"><h2 class="menu">Related</h2><p>Papers.</p></div><p class="search-terms-explained">Terms.</p>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class='page'>%s</div>"])
def test_slugs_of_titles_are_no_furniture(wrap):
    no = "".join(f"<div {x}>no</div>" for x in (
        "class='cookie-notice'", "id='cookie-notice'", "class='share-buttons'", "class='related-posts'", "id='comments'", "id='site-nav'",
        "class='search'", "class='ad'", "id='ad-slot-3'"))
    assert html_extract.main_text(f"<body><nav>menu</nav>{wrap % (SLUGS + no)}<footer>f</footer></body>") == (
        "Search and replace\nAll of it.\nDiscussion\nWhat it means.\nA follow-up\nWhat others did.\nRelated\nPapers.\nTerms.")
    old = "".join(f"<div {x}>no</div>" for x in ("id='header'", "id='menu'", "class='my-sidebar-x'", "id='search'"))
    assert html_extract.main_text(f"<body>{old}<div><p>Just this.</p></div></body>") == "Just this."


def test_links_decide_where_names_do_not():
    menu = "<ul><li><a href='/'>Home page</a><li><a href='/a'>About us</a></ul>"
    row = "<div><a href='/x'>News</a> | <a href='/y'>Sport</a> | <a href='/z'>Money</a></div>"
    story = "<p>One paragraph with <a href='#'>a link</a> in it.</p><p>And a second.</p>"
    more = "<ul>" + "".join(f"<li><a href='/{k}'>Another story {k}</a>" for k in range(4)) + "</ul>"
    want = "The title\nOne paragraph with a link in it.\nAnd a second."
    title = "<h1><a href='/t'>The title</a></h1>"
    assert html_extract.main_text(f"<body>{menu}{row}{title}{story}{more}{row}</body>") == want
    # between paragraphs a line of links is text, a list of them is not
    one = html_extract.main_text(f"<body>{menu}{title}{story}<p><a href='/s'>The source</a></p><p>The end.</p>{more}</body>")
    assert one == want + "\nThe source\nThe end."
    assert html_extract.main_text(f"<body>{title}{story}{more}<p>The end.</p></body>") == want + "\nThe end."
    marked = f"<body>{menu}<article>{title}{story}<p><a href='/s'>The source</a></p>{more}</article>{more}</body>"
    assert html_extract.main_text(marked) == want
    assert html_extract.main_text(marked.replace(more, "")) == want + "\nThe source"


def test_comments_and_consent_by_their_names():
    no = ("<section class='user-feedback'><p>I liked it a lot.</p></section><div id='reader-responses'><p>Me too.</p></div>"
          "<div class='cmp-root'><p>We value your privacy.</p></div>")
    for wrap in ("<article>%s</article>", "<div>%s</div>"):
        assert html_extract.main_text("<body>" + wrap % f"<h1>T</h1><p>Body.</p>{no}" + "</body>") == "T\nBody."


def test_lines_kept_like_plain_distances():
    """A line with a length stays; one of links stays if lines with a length
    stand before and behind it, less than a window apart."""
    rng = random.Random(6)
    for _ in range(300):
        rows = [("x" * rng.randint(1, 9), rng.random() < .2, False, rng.choice([0, 0, 9])) for _ in range(rng.randint(0, 14))]
        rows = [(t, bad, art, min(plain, len(t))) for t, bad, art, plain in rows]
        rows = [(f"{t}{k}", bad, art, plain and plain + len(str(k))) for k, (t, bad, art, plain) in enumerate(rows)]
        heavy = [k for k, (_, bad, _, plain) in enumerate(rows) if plain and not bad]
        want = []
        for k, (text, bad, _, _) in enumerate(rows):
            before, behind = [h for h in heavy if h < k], [h for h in heavy if h > k]
            near = before and behind and behind[0] - before[-1] <= html_extract.WINDOW
            if not bad and (k in heavy or near):
                want.append(text)
        assert html_extract._select(rows) == "\n".join(want)


def test_surge_and_dive():
    assert html_extract.stretches([0, 0, 5, 0, 7, 0, 0, 0, 3, 0]) == [(2, 5), (8, 9)]
    assert html_extract.stretches([]) == [] and html_extract.stretches([0, 0]) == []


def test_html_edges(spark):
    odd = [None, "", "plain text", "<p>", "<p>open <b>bold<p>next", "a<br>b", "<script>x", "<!-- open", "<p title='>'>q</p>",
           "&amp;lt; &notit; &#0;", "<div hidden>no</div><p>yes", "<article>" + "<div>" * 3000 + "deep", "< p>x</ p>",
           "<a " * 3000 + "'", "<article></article>", "<p>x</p>" * 20000]
    rows = [(k, "u", t, "clash") for k, t in enumerate(odd)]
    pages = spark.createDataFrame(rows + rows[4:5], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    texts = [got[k].text for k in range(len(odd))]
    assert texts[:9] == ["", "", "plain text", "", "open bold\nnext", "a b", "", "", "q"]
    assert texts[10] == "yes" and texts[11] == "deep" and texts[14] == ""
    assert texts[15] == "\n".join(["x"] * 20000) and all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract(pages).count() == len(odd) + 1 and html_extract.extract(pages.limit(0)).count() == 0


def test_html_query_gives_the_articles(spark):
    docs = {"\n".join(s for s in (" ".join(x.split()) for x in r.text.split("\n")) if s)
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op3_html_text(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.text.split("\n", 1)[1] in docs for r in got)


# ---- features

def test_slices_cover_every_gram_once():
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 3, 30, 250]) for _ in range(60)]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    seen = []
    for lo, hi, owner, starts in slices(offsets, 100, 3):
        ends = np.append(starts[1:], hi - lo)
        for o, a, b in zip(owner, starts, ends):
            assert offsets[o] <= lo + a and lo + b <= offsets[o + 1] and hi - lo <= 250
            seen += [(o, lo + x) for x in range(a, b - 3)]
    want = [(k, offsets[k] + x) for k, n in enumerate(sizes) for x in range(n - 3)]
    assert sorted(seen) == sorted(want)


def test_gram_sums_do_not_depend_on_neighbours():
    texts = ["alpha beta", "", "g", "delta " * 50, "é ü"]
    rng = np.random.default_rng(0)
    weights = np.vstack((rng.normal(size=(1 << 8, 2)), np.zeros((1, 2))))
    codes = np.arange(256, dtype=np.uint8)

    def sums(column):
        out = np.zeros((len(column), 2))
        for part, owner, starts in features.pieces(pa.array(column), codes, 32, (2, 3)):
            s, _ = features.gram_sums(part, starts, (2, 3), 8, weights)
            np.add.at(out, owner, s)
            counts = features.gram_counts(part, starts, (2, 3), 8)
            assert np.allclose(counts @ weights[:-1], s, atol=1e-4)
        return out
    together = sums(texts)
    assert np.allclose(together, np.vstack([sums([t]) for t in texts]))


# ---- language

def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op4_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= .97 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_votes_like_brute_force():
    rng = np.random.default_rng(12)
    codes = ["en", "de", "nl", "fr", "es", "xa", "xb", "xc"]
    base = rng.random((len(codes), 1 << langid.BITS)) < .01
    label = np.repeat(np.arange(len(codes)), 12)
    counts = (rng.poisson(3, (len(label), 1 << langid.BITS)) * (base[label] | (rng.random((len(label), 1 << langid.BITS)) < .002))).astype(np.float32)
    m = langid.Model(codes, counts, label)
    assert m.of[:5] == ["germanic"] * 3 + ["romance"] * 2 and m.of[5:] == ["other"] * 3
    margins = counts / counts.sum(axis=1, keepdims=True) @ m.weights[:-1] + np.array(m.bias)
    margins = np.concatenate((margins, rng.normal(size=(60, margins.shape[1])) * .2))
    best, score = m.decide(margins)
    assert (best[:len(label)] == label).mean() > .95

    def tally(row, kind, members):
        votes, total, sure = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
        for k, (what, a, b) in enumerate(m.pairs):
            if what == kind and a in votes and b in votes:
                votes[a if row[k] >= 0 else b] += 1
                total[a] += row[k]
                total[b] -= row[k]
                p = 1 / (1 + np.exp(-4 * row[k]))
                sure[a], sure[b] = min(sure[a], p), min(sure[b], 1 - p)
        won = max(members, key=lambda x: (votes[x], total[x], -x))
        return won, sure[won]

    for row, k, s in zip(margins, best, score):
        family, p = tally(row, "family", list(range(len(m.families))))
        language, q = tally(row, "language", [i for i, f in enumerate(m.of) if f == m.families[family]])
        assert language == k and abs(p * q - s) < 1e-9


def test_many_labels_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 5)
    monkeypatch.setattr(langid, "MAX_ROWS", 20)
    rng = random.Random(3)
    of = {f"x{k}": ["".join(rng.choices("abcdefghijklmnopqrst"[k:k + 9], k=6)) for _ in range(8)] for k in range(12)}
    docs = spark.createDataFrame([(100 * k + j, " ".join(rng.choices(of[f"x{k}"], k=30)), f"x{k}", "s", 1)
                                  for k in range(12) for j in range(40 - k)], DOCS)
    model = langid.train(docs, F.lit(True))
    assert model.languages == [f"x{k}" for k in range(5)]
    got = langid.predict(docs, model, ["doc_id", "lang"]).where(F.col("lang").isin(model.languages)).collect()
    assert sum(r.lang_pred == r.lang for r in got) > .9 * len(got)


def test_families_are_learned_in_bounded_groups():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 40))
    means = centre[np.arange(30) % 6] + .05 * rng.normal(size=(30, 40))
    got = langid.grouped(means, size=5)
    assert len(set(got)) == 6 and max(map(got.count, got)) == 5
    assert all(got[k] == got[k % 6] for k in range(30))
    assert langid.grouped(means[:1]) == [0] and max(map(langid.grouped(rng.normal(size=(50, 8))).count, range(7))) <= 8


def test_language_edges(spark):
    rng = random.Random(0)
    words = {"en": "the of and with that is", "de": "der die und nicht schön über", "fr": "le la été où dans une", "xx": "zq qz zzq qqz zqz"}
    rows = [(k, " ".join(rng.choices(words[c].split(), k=20)), c, "s", 1) for k in range(60) for c in words]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs, F.lit(True))
    assert model.families == ["germanic", "other", "romance"]
    odd = [(1, None), (2, ""), (3, "123 !! 45"), (None, "und nicht der die"), (5, "the with that"), (5, "the with that"),
           (6, "où été dans la " * 100_000), (7, "Zq Qz!")]
    frame = spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang_pred_old", F.lit("x"))
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(frame, model, ["doc_id"]).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "de"), (5, "en"), (6, "fr"), (7, "xx")}
    none = langid.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.predict(frame, none, ["doc_id"]).collect()} == {"und"}
    one = langid.train(docs.where("lang = 'de'"), F.lit(True))
    assert {r.lang_pred for r in langid.predict(frame, one, ["doc_id"]).collect()} == {"und", "de"}


# ---- quality

def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op7_quality(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= .9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows)


def test_quality_votes_like_brute_force():
    rng = np.random.default_rng(1)
    counts = rng.poisson(.05, size=(80, quality.WIDTH)).astype(np.float32)
    label = (counts[:, :40].sum(axis=1) > 2).astype(float)
    model = quality.Model(counts, label, axes=10)
    got = model.score(counts[:20], neighbours=7)
    points = model._weigh(counts) @ model.axes
    points /= np.linalg.norm(points, axis=1)[:, None]
    for k in range(20):
        near = points @ points[k]
        top = np.argsort(-near)[:7]
        assert abs((np.maximum(near[top], 1e-6) * label[top]).sum() / np.maximum(near[top], 1e-6).sum() - got[k]) < 1e-3


def test_repeat_shares_like_plain_counts_whatever_the_length():
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(size)], k=n)) for size, n in
             ((3, 40), (60, 500), (30, 5000), (30, 500), (1, 1), (5, 0), (2000, 3000))] + [None, "a a a a", "x\ny x"]
    got = quality._repeats(pa.array(texts, pa.string()))
    for row, text in zip(got, texts):
        w = (text or "").split()
        n = max(1, len(w))
        want = [sum(a == b for a, b in zip(w, w[k:])) / n for k in (1, 2)]
        near = sum(w[i] in w[max(0, i - quality.NEAR):i] for i in range(len(w))) / n
        assert np.allclose(row, [*want, min(1, max(0, 2 * (near - .5)))])
    assert abs(got[2] - got[3]).max() < .1      # ten times the text, the same shares


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "Good plain words here.", "en", "s", 1), (2, "BAD!! BAD!! BAD!!", "en", "s", 1), (3, None, None, None, None),
                                  (None, "", "en", "s", 0), (2, "BAD!! BAD!! BAD!!", "en", "s", 1), (4, "x " * 300_000, "en", "s", 1)], DOCS)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (9, 1), (1, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    assert len(model.label) == 2
    got = quality.score(docs.withColumn("score", F.lit("old")), model, ["doc_id"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (3, None)} == {.5}
    assert quality.keep_good(docs, model).columns == docs.columns
    none = quality.train(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, none, ["doc_id"]).collect()} == {.5}
    assert quality.score(docs.limit(0), model, ["doc_id"]).count() == 0


# ---- decontamination

def plain_edits(item, text):
    """Least edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i in range(1, len(item) + 1):
        new = [i]
        for j in range(1, len(text) + 1):
            new.append(min(row[j - 1] + (item[i - 1] != text[j - 1]), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_contamination_against_plain_alignment(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 25)))) for k in range(6)]
    docs = []
    for k in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.choice([0, 0, 1, 2, 4, 7, 12])):
            at = rng.randrange(len(text))
            text[at:at + rng.choice([0, 1])] = rng.choice(["", "x", "Y", "zz"])
        if k % 7 == 0:
            text = text[:len(text) // 2]
        docs.append((k, " ".join(word() for _ in range(rng.randint(0, 30))) + "  " + "".join(text).upper() + "\n" + word()))
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for d, t in docs:
        for i, item in items:
            a, b = decontaminate.normal(item), decontaminate.normal(t)
            most = min(int(decontaminate.EDITS * len(a)), (len(a) - decontaminate.Q) // decontaminate.Q)
            if (e := plain_edits(a, b)) <= most:
                want[d, i] = e
    assert got == want and len({e for e in want.values()}) > 2


def test_contamination_edges(spark, monkeypatch):
    item = "this is one whole benchmark item, long enough to count as one of them"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short one"), (None, item), (5, item.replace("one", "two"))],
                                  "item_id long, text string")
    huge = "filler words that go on " * 120_000
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, item, "x"), (3, item, "x"), (None, f"a {item.upper()} b", "x"),
                                  (4, "short one", "x"), (5, huge + item + huge, "x"), (6, huge, "x")], "doc_id long, text string, edits string")
    hits = decontaminate.contamination(docs, bench)
    got = sorted(((r.doc_id, r.item_id) for r in hits.collect()), key=str)
    assert got == [(3, 1), (3, 1), (5, 1), (None, 1)]
    assert sorted(str(r.doc_id) for r in decontaminate.drop_contaminated(docs, bench).collect()) == ["1", "2", "4", "6"]
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert sorted(((r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()), key=str) == got


def test_items_of_any_length(spark, monkeypatch):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    of = lambda n: " ".join(word() for _ in range(n // 4 + 1))[:n].strip()
    items = {n: of(n) for n in (12, 13, 20, 36, 39, 40, 41, 81, 5_000, 700_000, 2 << 20)}
    items = {k: t for k, t in items.items() if len(t) >= 12}
    fill = of(600_000)
    docs = [(k, f"{fill} {t} {of(3000)}") for k, t in items.items()] + [(1, fill)]
    docs += [(1000 + k, f"{of(50)}x{t}y {of(50)}") for k, t in items.items() if k < 40]     # inside longer words
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for piece in (1 << 16, decontaminate.PIECE):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contamination(frame, bench).collect()}
        assert got == {(k, k, 0) for k in items}


def test_items_without_an_id(spark):
    a, b = "the first of two benchmark items, quite long enough", "the other of the two benchmark items, long enough too"
    bench = spark.createDataFrame([(1, a), (None, a), (None, b)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {a}"), (2, f"{b} y"), (3, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()), key=str)
    assert got == [(1, 1), (2, None)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [3]


def test_contamination_normalises_items_and_documents_alike(spark):
    item = "this is one whole benchmark item, long enough to count as one of them, and in it ο δρομος της πολης, istanbul"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    spaced = item
    for k, space in enumerate("\u00a0\u3000\u2003\u2028\u0085\x1c\u202f"):
        at = [m.start() for m in re.finditer(" ", item)][2 * k]
        spaced = spaced[:at] + space + spaced[at + 1:]
    docs = spark.createDataFrame([(1, f"x {spaced} y"), (2, item.upper()), (3, item.replace("i", "İ")), (4, item.replace(" ", "\u3000 \u00a0"))],
                                 "doc_id long, text string")
    for items in (bench, spark.createDataFrame([(1, spaced)], "item_id long, text string")):
        got = {(r.doc_id, r.edits) for r in decontaminate.contamination(docs, items).collect()}
        assert got == {(1, 0), (2, 0), (3, 0), (4, 0)}
        assert decontaminate.drop_contaminated(docs, items).count() == 0


def test_contamination_query_finds_the_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op6_decontaminate(spark, SF).collect()}
    assert got == {(d.doc_id, i.item_id) for d in docs for i in items if decontaminate.normal(i.text) in decontaminate.normal(d.text)}
    assert got


def test_crc(spark):
    row = spark.range(3, 4).select(crc_mod("id", 4).alias("c")).first()
    assert row.c == zlib.crc32(b"3") % 4 and re.match("", "")
