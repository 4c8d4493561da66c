"""Driver queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm import (decontaminate, html_extract, langid, line_dedup, mixing, near_vectors, periodic, quality,
                         repetition, simhash, spelling, url_filter, wavelet)
from daylake.llm.common import crc_mod, table
from daylake.session import run_folder

# (host, path, action)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removed units, by their offsets in the original texts."""
    gone = line_dedup.removals(table(spark, sf_dir, "documents"))
    return gone.select("doc_id", F.col("start").alias("start_char"), F.col("end").alias("end_char"),
                       F.col("words").alias("n_words"), F.lower(F.hex("digest")).alias("digest"),
                       "first_doc_id", F.col("first_start").alias("first_start_char"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs, F.col("doc_id").isNotNull() & ~held_out)
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, ["doc_id", "held_out"])


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, each with the items it holds."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    return quality.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    scored = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"),
                           quality_model(spark, docs, sf_dir), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "tokens")
    wavelet.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return wavelet.read_documents(spark, path)


def token_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the end id stands in all tokens, from the files: counted by rank,
    found by select."""
    path = run_folder(spark, "tokens")
    wavelet.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    n = wavelet.count_token(spark, path, wavelet.END_ID).agg(F.sum("n")).first()[0] or 0
    return wavelet.locate_token(spark, path, wavelet.END_ID).withColumn("n_all", F.lit(n).cast("long"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = url_filter.url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_text": op3_html_text,
    "op4_language": op4_language,
    "op5_source_mix": op5_source_mix,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality": op7_quality,
    "op8_wavelet_tokens": op8_wavelet_tokens,
    "token_positions": token_positions,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_repetition": op11_repetition,
    "op12_spelling": op12_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

_PARTS = """
  SELECT page_id, url,
    CASE WHEN strpos(url, '://') > 0
         THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*', 0),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0
         THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path
  FROM pages"""

def _uniform(seed: int, *parts: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce(({p})::VARCHAR, '\\N')" for p in parts]])
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)!r}::DOUBLE)"


_TEXT_MD5 = "md5(coalesce(text, '\\N'))"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 of a list of bytes: the table from its polynomial, then one step a byte.
_CRC_TABLE = """
crc_step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8)"""


def _crc(bytes_: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, {bytes_}), "
            "lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)")


def _repetition_sql() -> str:
    lengths = [repetition.WINDOW, *repetition.LIMITS]
    grams = " UNION ALL ".join(
        f"SELECT d, i, {n} AS n, list_slice(words, i, i + {n - 1}) AS gram "
        f"FROM (SELECT d, words, unnest(range(1, len(words) - {n - 2})) AS i FROM docs WHERE len(words) >= {n})"
        for n in lengths)
    kept = " AND ".join(f"100 * coalesce(dup_chars_{n}, 0) <= {limit} * word_chars"
                        for n, limit in repetition.LIMITS.items())
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
grams AS ({grams}),
inside AS (
  SELECT DISTINCT d, n, unnest(range(i, i + n)) AS pos
  FROM (SELECT d, n, i, count(*) OVER g AS c, row_number() OVER (g ORDER BY i) AS r
        FROM grams WINDOW g AS (PARTITION BY d, n, gram))
  WHERE r > 1 OR (n = {repetition.WINDOW} AND c > 1)),
covered AS (
  SELECT d, count(*) FILTER (n = {repetition.WINDOW}) AS n_repeat_words,
    {', '.join(f"sum(length(words[pos])) FILTER (n = {n}) AS dup_chars_{n}" for n in repetition.LIMITS)}
  FROM inside JOIN docs USING (d) GROUP BY d),
lines AS (
  SELECT d, line, count(*) AS c,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT d, unnest(string_split(text, chr(10))) AS line FROM docs) GROUP BY ALL),
dup_lines AS (
  SELECT d, sum(c - 1) AS n_dup_lines, sum(chars * (c - 1)) AS dup_line_chars
  FROM lines WHERE chars > 0 GROUP BY d),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
    {', '.join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in repetition.LIMITS)}
  FROM docs LEFT JOIN covered USING (d) LEFT JOIN dup_lines USING (d))
SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT} * n_words AS base_failed,
  NOT base_failed AND 100 * dup_line_chars <= {repetition.LINE_LIMIT} * word_chars AND {kept} AS kept
FROM counts"""


def _spelling_sql() -> str:
    low, ratio = spelling.MIN_POINTS, spelling.RATIO
    points = ("flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END"
              " FOR x IN string_split(s, '')])")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT id, w, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= {low} GROUP BY ALL),
hashed AS (
  SELECT w, n, {_crc(points)} AS h FROM (SELECT w, n, id || ':' || w AS s FROM runs), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {spelling.DROP_EVERY} = 0
           THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n
    FROM hashed)
  WHERE length(word) >= {low} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b USING (i, cut) WHERE a.word <> b.word
  UNION SELECT word, cut FROM cuts WHERE cut IN (SELECT word FROM words)
  UNION SELECT cut, word FROM cuts WHERE cut IN (SELECT word FROM words)),
ranked AS (
  SELECT p.word, near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, near) AS r
  FROM pairs p JOIN words v ON v.word = near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= {ratio} * w.n THEN near END AS form, CASE WHEN near_n >= {ratio} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r = 1),
chain(word, last) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed l ON l.word = c.last AND l.form IS NULL"""


def _periodic_sql() -> str:
    digits = "[ord(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (
  SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS words, len(words) AS n,
    CASE WHEN doc_id IS NULL THEN 1 ELSE {_crc(digits)} END AS h FROM documents, crc_table),
docs AS (
  SELECT d, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    [words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] ELSE words END AS words
  FROM (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM given)),
grams AS (
  SELECT d, i, list_slice(words, i + 1, i + 5) AS gram
  FROM (SELECT d, words, unnest(range(len(words) - 4)) AS i FROM docs WHERE len(words) >= 5)),
pairs AS (SELECT a.d, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.d = b.d AND a.gram = b.gram AND a.i < b.i),
islands AS (
  SELECT d, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS g FROM pairs) GROUP BY d, q, g),
runs AS (
  SELECT d, start, length, min(q) AS q FROM islands
  WHERE length >= greatest({periodic.MIN_LENGTH}, {periodic.MIN_PERIODS} * q) GROUP BY d, start, length),
best AS (
  SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs
  FROM runs GROUP BY d),
top AS (
  SELECT d, start, length, q,
    row_number() OVER (PARTITION BY d ORDER BY length::DOUBLE / q DESC, start, q) AS r FROM runs),
dropped AS (SELECT d, list_distinct(flatten(list(range(start + q, start + length)))) AS gone FROM runs GROUP BY d),
words AS (
  SELECT d, string_agg(w, ' ' ORDER BY i) AS kept FROM (
    SELECT d, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS w FROM docs)
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT d AS e, unnest(gone) AS j FROM dropped) x WHERE e = d AND j = i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (d) LEFT JOIN words USING (d) LEFT JOIN top ON top.d = docs.d AND r = 1"""


ORACLE: dict[str, str] = {
    "op1_near_vectors": f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS node, * FROM (
    SELECT DISTINCT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0)),
links AS (
  SELECT a.node AS a, b.node AS b FROM v a JOIN v b
    ON a.label = b.label AND a.node <> b.node AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {near_vectors.THRESHOLD}),
reach(node, other) AS (
  SELECT node, node FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
comp AS (SELECT r.node, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.node = r.other GROUP BY r.node),
deg AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(deg.n, 0) AS n_links, coalesce(comp.component_id, e.vec_id) AS component_id,
       coalesce(comp.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN v ON v.vec_id = e.vec_id AND v.label = e.label AND v.e = e.embedding::DOUBLE[]
LEFT JOIN comp ON comp.node = v.node LEFT JOIN deg ON deg.node = v.node""",
    "op5_source_mix": f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS weight FROM documents GROUP BY source),
rates AS (SELECT source, weight / (SELECT sum(weight) FROM counts) * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts),
chunks AS (SELECT source, ceil(rate / {mixing.CHUNK})::INT AS draws, rate / ceil(rate / {mixing.CHUNK}) AS rate FROM rates),
cdf(source, rate, k, p, cdf) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM chunks
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM cdf
  WHERE k < {int(mixing.CHUNK) + mixing.TAIL - 1}),
tables AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, {_TEXT_MD5} AS t,
         list_sum([len([x FOR x IN b.cdf IF x <= {_uniform(mixing.SEED, 'd.doc_id', _TEXT_MD5, 'i')}])
                   FOR i IN range(1, c.draws + 1)]) AS n
  FROM documents d JOIN chunks c ON d.source IS NOT DISTINCT FROM c.source
  JOIN tables b ON d.source IS NOT DISTINCT FROM b.source),
copied AS (SELECT doc_id, text, lang, source, n_chars, t, unnest(range(1, n::BIGINT + 1)) AS copy FROM drawn)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, {_uniform(mixing.SEED + 1, 'doc_id', 't', 'copy')} AS mix_key
FROM copied""",
    "op10_url_filter": f"""
WITH rules(r_host, r_path, action) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
parts AS ({_PARTS}),
best AS (
  SELECT u.host, u.path,
         max({{'n': length(r_host) + length(r_path), 'hl': length(r_host), 'rule': r_host || r_path, 'action': action}}) AS b
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules
    ON (u.host = r_host OR ends_with(u.host, '.' || r_host)) AND starts_with(u.path, r_path)
  GROUP BY ALL)
SELECT page_id, p.host, p.path, b.rule AS rule, coalesce(b.action, 'allow') AS verdict
FROM parts p LEFT JOIN best USING (host, path)""",
    "op11_repetition": _repetition_sql(),
    "op12_spelling": _spelling_sql(),
    "op13_periodic_runs": _periodic_sql(),
}
