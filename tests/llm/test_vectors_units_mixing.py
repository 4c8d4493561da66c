import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daylake.llm import line_dedup, mixing, near_vectors, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def closure(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- vectors

def plain_vectors(rows, threshold=0.93):
    ok = {}
    for i, e, label in rows:
        if label is None or not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            continue
        ok[i] = (np.array(e, float), label)
    pairs = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0])
             and ok[a][0] @ ok[b][0] / np.sqrt((ok[a][0] @ ok[a][0]) * (ok[b][0] @ ok[b][0])) >= threshold]
    n = {i: 0 for i, *_ in rows}
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    return n, closure(pairs, [i for i, *_ in rows])


@pytest.mark.parametrize("block", [7, 2048])
def test_vectors_against_all_pairs(spark, block):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        base = rng.normal(size=16)
        for _ in range(10):
            rows.append((base + rng.normal(size=16) * rng.choice([0, .1, .25, .35])) * rng.choice([1, 3]))
    rows = [(k * 3 % 127, [float(np.float32(x)) for x in v], k % 2) for k, v in enumerate(rows)]
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [1.0] * 15 + [float("nan")], 0), (203, [1.0] * 15 + [None], 0),
             (204, [1.0] * 3, 0), (205, [2.0] * 3, 0), (206, rows[0][1], None), (207, [], 0),
             (208, [float("inf")] + [0.0] * 15, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, component string")
    got = {r.vec_id: r for r in near_vectors.near_vectors(frame, block=block).collect()}
    n, comp = plain_vectors(rows)
    assert {i: r.n_links for i, r in got.items()} == n
    assert {i: r.component_id for i, r in got.items()} == comp
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_vectors_repeated_rows_and_empty(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (None, [1.0, 0.0], 1)],
                                  "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors.near_vectors(frame).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False)]
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0


def test_vectors_of_extreme_size(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [1e200, 1e199], 1), (3, [3.0, 0.1], 1), (4, [5e-324, 0.0], 1), (5, [0.0, 1e308], 1),
            (6, [1e-160, 1e-160], 1), (7, [2.0, 2.0], 1), (8, [1e308, 1e308], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (2, 6), 7: (2, 6), 8: (2, 6)}


def test_rows_that_share_an_id_are_vectors_of_their_own(spark, duck):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [1.0, 0.05], 1), (1, [0.0, 1.0], 2), (3, [0.0, 1.0], 2),
            (9, [-1.0, 0.0], 1), (0, [-1.0, 0.1], 1), (0, [0.0, 1.0], 1), (5, [0.1, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors.near_vectors(frame).collect()))
    assert got == [(0, 1, 0, True), (0, 1, 0, True), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
                   (3, 1, 1, False), (5, 1, 0, False), (9, 1, 0, False)]
    table = "(values " + ", ".join(f"({i}, {v}::float[], {label})" for i, v, label in rows) + ") as embeddings(vec_id, embedding, label)"
    sql = queries.ORACLE["op1_near_vectors"].replace("FROM embeddings e", "FROM given e").replace("FROM embeddings", "FROM given")
    sql = sql.replace("WITH RECURSIVE", f"WITH RECURSIVE given AS (SELECT * FROM {table}),", 1)
    assert sorted(duck.sql(sql).fetchall()) == got


@pytest.mark.parametrize("held", [8 * 2 * 16, 1 << 24])
def test_parts_of_a_cell_lose_nothing(spark, monkeypatch, held):
    monkeypatch.setattr(near_vectors, "HELD_BYTES", held)
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in np.float32(rng.normal(size=2))], k % 2) for k in range(150)]
    got = {r.vec_id: r for r in near_vectors.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block=5).collect()}
    n, comp = plain_vectors(rows)
    assert {i: r.n_links for i, r in got.items()} == n and {i: r.component_id for i, r in got.items()} == comp


def test_tile_ends_early_but_loses_nothing():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 32))[rng.integers(0, 40, 300)] + .25 * rng.normal(size=(300, 32))
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j, _ = near_vectors.tile_links(x, x, axes, 0.93, True)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.triu(u @ u.T >= 0.93, 1))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist())) and len(i) > 10


def test_vector_query_against_sql(spark, duck):
    got = sorted(map(tuple, queries.op1_near_vectors(spark, SF).select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == sorted(duck.sql(queries.ORACLE["op1_near_vectors"]).fetchall())


# ---- repeated units

def plain_removals(docs, unit="sentence", min_words=line_dedup.MIN_WORDS):
    first, out = {}, []
    for d, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        for s, e, w, g in line_dedup.units(t or "", unit, min_words):
            if g in first and first[g] != (d, s):
                out.append((d, s, e, w, *first[g]))
            first.setdefault(g, (d, s))
    return out


def test_units_query_against_plain_loop(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op2_line_dedup(spark, SF).drop("digest").collect()
    assert sorted((r.doc_id, r.start_char, r.end_char, r.n_words, r.first_doc_id, r.first_start_char) for r in got) \
        == sorted(plain_removals(docs))


def test_units_edges(spark):
    long = "one two three four five six seven eight nine."
    passage = " ".join(f"word{k}{'.' if k % 13 == 12 else ''}" for k in range(60))
    rows = [(2, f"{long}\n{long}\nshort line", "x"), (1, f"ONE,  two three FOUR five six seven eight nine", "x"),
            (None, long, "x"), (5, None, "x"), (6, "", "x"), (7, "short line", "x"),
            (8, f"Quite other words go here and {passage} and on they go.", None),
            (9, f"Nothing the same, none at all, {passage} ends as it ends.", None), (9, f"Nothing the same, none at all, {passage} ends as it ends.", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed string")
    gone = line_dedup.removals(docs)
    by = {}
    for r in gone.collect():
        by.setdefault(r.doc_id, set()).add((r.start, r.end, r.first_doc_id))
    assert by[2] == {(0, 45, 1), (46, 91, 1)} and by[None] == {(0, 45, 1)}
    assert set(by) == {2, None, 9} and all(f == 8 for *_, f in by[9])
    kept = {(r.doc_id, r.text) for r in line_dedup.remove(docs, gone).collect()}
    assert (2, "\n\nshort line") in kept and (None, "") in kept and (5, None) in kept and (7, "short line") in kept
    nine = next(t for d, t in kept if d == 9)
    assert nine.startswith("Nothing the same") and "word20" not in nine and "word45" not in nine
    assert line_dedup.removals(docs.limit(0)).count() == 0
    assert line_dedup.removals(docs, unit="line").where("doc_id = 2").count() == 2
    assert line_dedup.removals(docs, unit="paragraph").where("doc_id = 2").count() == 0


def test_units_find_a_passage_at_any_offset_and_phase(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    docs = []
    for k in range(24):  # half of the passages without any mark
        passage = " ".join(word() + (rng.choice(["", "", "", "", ",", "."]) if k % 2 else "") for _ in range(50))
        for copy in (0, 1):
            lead = " ".join(word() + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(0, 20)))
            docs.append((2 * k + copy, f"{lead} {passage} {' '.join(word() for _ in range(rng.randint(0, 9)))}"))
    gone = {}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in line_dedup.remove(frame, line_dedup.removals(frame)).collect():
        gone[r.doc_id] = [(x.start, x.end) for x in r.removed or ()]
    first, lost = {}, []
    for d, text in docs:
        words = list(line_dedup.WORD.finditer(text))
        shared = set()
        for k in range(len(words) - line_dedup.MIN_WORDS + 1):  # brute force: every run of 8 words
            gram = tuple(m.group() for m in words[k:k + line_dedup.MIN_WORDS])
            if first.setdefault(gram, d) != d:
                shared.update(range(k, k + line_dedup.MIN_WORDS))
        out = {k for k, m in enumerate(words) if any(a <= m.start() < b for a, b in gone[d])}
        assert out <= shared and (d % 2 or not out)  # nothing else, and the first copy stays
        assert all(a[1] < b[0] for a, b in zip(gone[d], gone[d][1:]))
        if d % 2:
            assert len(shared) >= 50 and out
            lost.append(1 - len(out) / len(shared))
    assert max(lost) < .5 and sum(lost) / len(lost) < .25


def test_units_keep_the_first_copy_of_a_text_that_repeats_itself(spark):
    docs = spark.createDataFrame([(1, "so, " * 30), (2, "so, " * 30)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove(docs, line_dedup.removals(docs)).collect()}
    assert got[1].count("so") >= line_dedup.MIN_WORDS and got[2].count("so") < line_dedup.MIN_WORDS


# ---- mixing

def test_poisson_inverse_is_the_distribution(spark):
    grid = [(r, (k + .5) / 400) for r in (0.01, 0.4, 1.0, 7.5, 16.0) for k in range(400)]
    rows = spark.createDataFrame(grid, "r double, u double").select(
        "r", "u", mixing.poisson_inverse(F.col("r"), F.col("u")).alias("k")).collect()
    for row in rows:
        p = cdf = math.exp(-row.r)
        k = 0
        while cdf <= row.u:
            k += 1
            p = p * row.r / k
            cdf += p
        assert row.k == k


def test_mixing_reaches_the_weights_and_repeats_itself(spark):
    rows = [(k, f"text {k}", "en", "hot" if k % 3 else f"s{k % 4}", 1) for k in range(6000)] + [(9000 + k, "n", "en", None, 1) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    want = {"hot": .25, "s0": .25, "s1": .2, "s2": .1, "s3": 0.0, None: .2}
    weights = spark.createDataFrame(list(want.items()) + [("absent", 5.0)], "source string, weight double")
    weights = weights.where("source is null or source <> 'absent'")
    one = mixing.mix(docs, weights)
    got = {r.source: r.n for r in one.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert "s3" not in got
    for s, w in want.items():
        if w:
            assert abs(got[s] - w * len(rows)) < 6 * math.sqrt(max(1, w * len(rows) * len(rows) / len(rows)) * 3)
    again = mixing.mix(docs.repartition(7, "lang", "doc_id"), weights)
    pick = ["doc_id", "copy", "mix_key"]
    assert sorted(map(tuple, one.select(*pick).collect())) == sorted(map(tuple, again.select(*pick).collect()))
    order = [r.mix_key for r in one.coalesce(1).collect()]
    assert len(set(order)) > .9 * len(order)


def test_mixing_high_rates_and_edges(spark):
    docs = spark.createDataFrame([(1, "a", "en", "rare", 1)] + [(k, None if k % 5 else "", None, "much", 1) for k in range(2, 400)],
                                 DOCS + "").withColumn("copy", F.lit("clash"))
    weights = spark.createDataFrame([("rare", 1.0), ("much", 1.0)], "source string, weight double")
    n = {r.source: r.n for r in mixing.mix(docs, weights).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert 120 < n["rare"] < 290 and 120 < n["much"] < 290
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs, weights.limit(0)).count() == 0
    twice = docs.where("doc_id = 1").unionAll(docs.where("doc_id = 1"))
    assert mixing.mix(twice).groupBy("copy").count().where("count <> 2").count() == 0


def test_mixing_query_against_sql(spark, duck):
    got = queries.op5_source_mix(spark, SF)
    names = sorted(got.columns)
    want = duck.sql(f"select {', '.join(names)} from ({queries.ORACLE['op5_source_mix']})").fetchall()
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)
