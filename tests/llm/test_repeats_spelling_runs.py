import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daylake.llm import periodic, queries, repetition, spelling
from daylake.llm.words import Words, slabs

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted(map(repr, (tuple(r.asDict().items()) for r in df.collect())))


def same_as_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    names = got.columns
    want = duck.execute(f"select {', '.join(names)} from ({queries.ORACLE[name]})").fetchall()
    got = [tuple(r) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


# ---- words

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é漢\n\t\r\x0b ", max_size=30)), max_size=6))
def test_words_like_the_pattern(texts):
    words = Words(pa.array(texts, pa.string()))
    plain = [WORD.findall(t or "") for t in texts]
    assert words.counts.tolist() == [len(p) for p in plain]
    flat = [w.encode() for p in plain for w in p]
    assert [words.word(k) for k in range(len(words.starts))] == flat
    for a, b in itertools.combinations(range(len(flat)), 2):
        assert (words.ids[a] == words.ids[b]) == (flat[a] == flat[b])


def test_slabs_cover_all_rows():
    texts = pa.array(["x" * n for n in (0, 5, 50, 1, 1, 0, 9)] + [None])
    cut = list(slabs(texts, 10))
    assert [a for a, _ in cut] == [0, *[b for _, b in cut[:-1]]] and cut[-1][1] == len(texts)
    assert list(slabs(texts.slice(0, 0))) == []


# ---- repetition

def plain_repetition(text):
    words = WORD.findall(text or "")
    out = {"n_words": len(words), "word_chars": sum(map(len, words)),
           "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    seen, lines, chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            if line in seen:
                lines += 1
                chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    out["n_dup_lines"], out["dup_line_chars"] = lines, chars
    for n in [3, *repetition.LIMITS]:
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count, met = Counter(grams), set()
        every, later = set(), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                every |= set(range(i, i + n))
            if g in met:
                later |= set(range(i, i + n))
            met.add(g)
        if n == 3:
            out["n_repeat_words"] = len(every)
        else:
            out[f"dup_chars_{n}"] = sum(len(words[i]) for i in later)
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    out["kept"] = not out["base_failed"] and 5 * out["dup_line_chars"] <= out["word_chars"] and all(
        100 * out[f"dup_chars_{n}"] <= limit * out["word_chars"] for n, limit in repetition.LIMITS.items())
    return out


def check_repetition(texts):
    got = repetition.measure(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert {c: got[c][k].item() for c in got} == plain_repetition(text), text


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é", "\n", "  ", "#", "漢 "]), max_size=80)
                          .map(" ".join)), min_size=1, max_size=4))
def test_repetition_like_plain_counts(texts):
    check_repetition(texts)


def test_repetition_when_hashes_collide(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(120)) for _ in range(4)]
    mix = repetition._mix
    monkeypatch.setattr(repetition, "_mix", lambda v: mix(v) & np.uint64(1))
    check_repetition(texts)


def test_repetition_limits():
    rng = random.Random(1)
    fresh = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    phrase = fresh[:12]
    some = " ".join(fresh + phrase * 1)
    much = " ".join(fresh[:60] + list(itertools.chain(*[[*phrase, f"x{k}"] for k in range(3)])))
    line = "\n".join([" ".join(fresh[:60]), *["the same line of words"] * 9])
    got = repetition.measure(pa.array([some, much, line, " ".join(fresh[:49])]))
    assert got["kept"].tolist() == [True, False, False, False]
    assert got["base_failed"].tolist() == [False, False, False, True]


def test_repetition_edges(spark):
    schema = f"{DOCS}, kept string, n_words string"
    long = " ".join(f"w{k}" for k in range(300_000)) + " end" * 10
    rows = [(1, None, None, None, 0, "x", "y"), (2, "", None, None, 0, "x", "y"), (None, "a b", None, None, 0, "x", "y"),
            (4, long, None, None, 0, "x", "y"), (4, "a b", None, None, 0, "x", "y"), (4, "a b", None, None, 0, "x", "y")]
    got = repetition.repetition(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [
        (0, 2, False), (1, 0, False), (2, 0, False), (4, 2, False), (4, 2, False), (4, 300_010, True)]
    assert repetition.repetition(spark.createDataFrame([], schema)).count() == 0


def test_repetition_query_against_sql(spark, duck):
    assert len(same_as_sql(spark, duck, "op11_repetition")) > 100


# ---- spelling

def edits_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(docs):
    total = Counter()
    for name, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if name is None else name}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= 2}


def plain_forms(words):
    out, form = {}, {}
    for w, n in words.items():
        near = [v for v in words if edits_one(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out[w] = [form[w], None, n, len(near), words[form[w]] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def forms_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("own,visitors,block", [(2048, 8192, 1024), (5, 7, 4)])
def test_forms_against_all_pairs(spark, monkeypatch, own, visitors, block):
    monkeypatch.setattr(spelling, "OWN", own)
    monkeypatch.setattr(spelling, "VISITORS", visitors)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    rng = random.Random(own)
    words = {"x" * 7: 10**12, "x" * 8: 10**10, "x" * 9: 10**9, "x" * 10: 4, "ÿ" * 7: 2, "xxxÿxxx": 3,
             "abcdefg": 50, "abcdegf": 60, "bacdefg": 5, "abcdefgh": 600, "abcdef÷": 600}
    for _ in range(25):
        w = [rng.choice("aeionrstléñ") for _ in range(rng.randrange(7, 10))]
        for _ in range(8):
            v = list(w)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(v))
                v[at:at + rng.randrange(2)] = rng.choice(["", "a", "é", "z"])
            if len(v) >= 7:
                words["".join(v)] = rng.choice([2, 3, 20, 30, 400, 5000])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert forms_of(spelling.variant_forms(frame)) == plain_forms(words)


def test_words_of_any_length(spark):
    long = "abc" * 2000
    words = {long: 30, long[:-1]: 3, long[:3000] + "x" + long[3001:]: 2, long + "zz": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert forms_of(spelling.variant_forms(frame)) == plain_forms(words)


def test_vocabulary_and_edges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    rng = random.Random(5)
    stock = ["Straßeñ", "ÀÉÎabcd", "wonderful", "wonderfull", "sixsix", "a×b÷cdefg", "tomorrow", "tomorow", "Ābcdefghi"]
    docs = [(rng.choice([None, 7, k]), " ".join(rng.choices(stock, k=30)), None, None, 0) for k in range(60)]
    docs += [(1, None, None, None, 0), (2, "", None, None, 0), docs[0], docs[0]]
    frame = spark.createDataFrame([(*d, "n") for d in docs], f"{DOCS}, word string")
    want = plain_words([d[:2] for d in docs])
    assert {r.word: r.n for r in spelling.vocabulary(frame).collect()} == want
    assert forms_of(spelling.spelling_variants(frame)) == plain_forms(want)
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


def test_spelling_query_against_sql(spark, duck):
    assert len(same_as_sql(spark, duck, "op12_spelling")) > 100


# ---- periodic runs

def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    smallest = {}
    for s, length, q in out:
        smallest[s, length] = min(q, smallest.get((s, length), q))
    return sorted((s, length, q) for (s, length), q in smallest.items())


def plain_row(doc_id, text, rewrite):
    words = WORD.findall(text or "")
    n = len(words)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def check_runs(docs, rewrite=False):
    got = periodic._slab([d for d, _ in docs], pa.array([t for _, t in docs], pa.string()), rewrite)
    assert list(map(tuple, got)) == [plain_row(d, t, rewrite) for d, t in docs]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=7), st.integers(1, 7)), max_size=5), max_size=4),
       st.booleans())
def test_runs_like_plain_search(parts, rewrite):
    check_runs([(k, " ".join(" ".join(unit * times) for unit, times in part)) for k, part in enumerate(parts)], rewrite)


def test_runs_of_nested_and_shared_periods():
    u, v = "a b a c".split(), "a b a d".split()
    words = (u * 5 + v) * 5 + u * 4 + ["x"] + (u + v) * 4 + ["a"] * 9
    thue = [0]
    for _ in range(9):
        thue += [1 - t for t in thue]
    shuffled = [f"w{k % 17}" for k in np.random.default_rng(2).integers(0, 17, 400)]
    check_runs([(1, " ".join(words)), (2, " ".join(map(str, thue))), (3, " ".join(map(str, thue * 4))),
                (4, " ".join(shuffled * 4)), (5, "w " * 3000), (6, " ".join(shuffled * 3))])


def test_rewritten_documents():
    rng = random.Random(8)
    docs = [(k, " ".join(rng.choices("abcdefghij", k=rng.randrange(0, 90)))) for k in range(300)]
    assert sum(periodic.plant(k, 50) is not None for k, _ in docs) > 10
    check_runs(docs, rewrite=True)


def test_runs_edges(spark):
    schema = f"{DOCS}, period string, id string"
    long = "x " + "a b " * 50_000 + " ".join(f"w{k}" for k in range(100_000))
    rows = [(1, None, None, None, 0, "x", "y"), (2, "", None, None, 0, "x", "y"), (None, "a " * 8, None, None, 0, "x", "y"),
            (4, long, None, None, 0, "x", "y"), (5, "a " * 8, None, None, 0, "x", "y"), (5, "a " * 8, None, None, 0, "x", "y")]
    got = {(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli)
           for r in periodic.periodic_runs(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, 0, None, None, None, None), (2, 0, None, None, None, None), (None, 1, 0, 8, 1, 8000),
                   (4, 1, 1, 100_000, 2, 50_000_000), (5, 1, 0, 8, 1, 8000)}
    assert periodic.periodic_runs(spark.createDataFrame([], schema)).count() == 0


def test_runs_query_against_sql(spark, duck):
    got = same_as_sql(spark, duck, "op13_periodic_runs")
    assert sum(r[1] > 0 for r in got) > 5
