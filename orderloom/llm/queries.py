"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, edit_counts, katz, langid, manifest, minhash, packing, pii, preferences, resample, suffixes, vectors
from .storage import reach_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            reach_workers(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def share(n: int):
    """``crc32`` of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


#: Words as the contracts have them: A-Z lower-cased, cut at spaces and \x09-\x0D.
WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

#: crc32 of a number's digits: the table of the reflected polynomial, then one step for each character.
CRC_SQL = """
crc_table AS (
  SELECT list(list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS t
  FROM range(256) r(n)),
crcs AS (
  SELECT doc_id, xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) AS crc
  FROM documents, crc_table)"""

KATZ_SQL = f"""
WITH {CRC_SQL},
tok AS (
  SELECT d.doc_id, c.crc % 5 = 1 AS held, unnest(list_concat({WORDS_SQL}, [' '])) AS w, generate_subscripts(list_concat({WORDS_SQL}, [' ']), 1) AS i
  FROM documents d JOIN crcs c ON d.doc_id = c.doc_id),
seq AS (
  SELECT *, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY i), '') AS h, coalesce(lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i), '') AS g FROM tok),
uni AS (SELECT w, count(*) AS c FROM seq WHERE NOT held GROUP BY w),
bi AS (SELECT h, w, count(*) AS c FROM seq WHERE NOT held GROUP BY h, w),
tri AS (SELECT g, h, w, count(*) AS c FROM seq WHERE NOT held GROUP BY g, h, w),
tot AS (SELECT sum(c) AS n, count(*) AS v FROM uni),
cc AS (
  SELECT k, c AS r, count(*) AS n FROM (SELECT 1 AS k, c FROM uni UNION ALL SELECT 2, c FROM bi UNION ALL SELECT 3, c FROM tri) WHERE c <= 6 GROUP BY k, c),
gt AS (
  SELECT a.k, a.r, (((a.r + 1) * b.n / a.n::DOUBLE / a.r) - x.rest) / (1 - x.rest) AS d
  FROM cc a JOIN cc b ON a.k = b.k AND b.r = a.r + 1
  JOIN (SELECT p.k, 6 * q.n / p.n::DOUBLE AS rest FROM cc p JOIN cc q ON p.k = q.k AND p.r = 1 AND q.r = 6) x ON x.k = a.k AND x.rest < 1),
ok AS (SELECT k, count(*) = 5 AND min(d) > 0 AND max(d) <= 1 AS good FROM gt GROUP BY k),
flat AS (
  SELECT k, CASE WHEN once > 0 THEN least(0.9, once / (once + 2 * twice)::DOUBLE) ELSE 0.5 END AS off
  FROM (SELECT k, coalesce(sum(n) FILTER (r = 1), 0) AS once, coalesce(sum(n) FILTER (r = 2), 0) AS twice FROM cc GROUP BY k)),
disc AS (
  SELECT f.k, r.r, CASE WHEN o.good THEN g.d ELSE 1 - f.off / r.r END AS d
  FROM flat f CROSS JOIN (SELECT unnest(range(1, 6)) AS r) r LEFT JOIN ok o ON o.k = f.k LEFT JOIN gt g ON g.k = f.k AND g.r = r.r),
p1 AS (SELECT u.w, u.c, u.c * coalesce(d.d, 1) / n AS p FROM uni u CROSS JOIN tot LEFT JOIN disc d ON d.k = 1 AND d.r = u.c),
unk AS (SELECT 1 - sum(p) AS p FROM p1),
m2 AS (SELECT b.h, b.w, b.c, b.c * coalesce(d.d, 1) AS m, p.p FROM bi b LEFT JOIN disc d ON d.k = 2 AND d.r = b.c JOIN p1 p ON p.w = b.w),
a2 AS (
  SELECT h, c + raised AS norm, (1 - m / (c + raised)) / (1 - p) AS a
  FROM (SELECT h, sum(c) AS c, sum(m) AS m, sum(p) AS p, CASE WHEN 1 - sum(m) / sum(c) < 1e-12 THEN 1 ELSE 0 END AS raised FROM m2 GROUP BY h)),
p2 AS (SELECT m.h, m.w, m.m / a.norm AS p FROM m2 m JOIN a2 a ON a.h = m.h),
m3 AS (
  SELECT t.g, t.h, t.w, t.c, t.c * coalesce(d.d, 1) AS m, p.p FROM tri t LEFT JOIN disc d ON d.k = 3 AND d.r = t.c JOIN p2 p ON p.h = t.h AND p.w = t.w),
a3 AS (
  SELECT g, h, c + raised AS norm, (1 - m / (c + raised)) / (1 - p) AS a
  FROM (SELECT g, h, sum(c) AS c, sum(m) AS m, sum(p) AS p, CASE WHEN 1 - sum(m) / sum(c) < 1e-12 THEN 1 ELSE 0 END AS raised FROM m3 GROUP BY g, h)),
p3 AS (SELECT m.g, m.h, m.w, m.m / a.norm AS p FROM m3 m JOIN a3 a ON a.g = m.g AND a.h = m.h)
SELECT s.doc_id, any_value(s.held) AS held_out, count(*) AS n_tokens, count(u.c) AS n_known, any_value(t.n)::BIGINT AS train_tokens,
  sum(log10((coalesce(u.c, 0) + 0.5) / (t.n + 0.5 * (t.v + 1)))) AS base_score,
  sum(CASE WHEN z.p IS NOT NULL THEN log10(z.p) WHEN y.p IS NOT NULL THEN log10(coalesce(c.a, 1)) + log10(y.p)
    ELSE log10(coalesce(c.a, 1)) + log10(coalesce(b.a, 1)) + log10(coalesce(u.p, k.p)) END) AS score
FROM seq s CROSS JOIN tot t CROSS JOIN unk k LEFT JOIN p1 u ON u.w = s.w LEFT JOIN p2 y ON y.h = s.h AND y.w = s.w LEFT JOIN a2 b ON b.h = s.h
  LEFT JOIN p3 z ON z.g = s.g AND z.h = s.h AND z.w = s.w LEFT JOIN a3 c ON c.g = s.g AND c.h = s.h
GROUP BY s.doc_id
"""


@query("op1_katz_scores", KATZ_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Base and trigram Katz scores of every document; trained where the id's share of 5 is not 1."""
    return katz.fit_and_score(table(spark, folder, "documents"), share(5) == 1, order=3).scores


MINHASH_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM docs),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common WHERE 100 * c >= 85 * (nx + ny - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, b.y FROM reach r JOIN ways b ON r.y = b.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.y) AS component_id, s.doc_id = min(r.y) AS kept
FROM sets s JOIN reach r ON s.doc_id = r.x GROUP BY s.doc_id, s.s
"""


@query("op2_minhash_dedup", MINHASH_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents on three-word shingles at 85 percent."""
    return minhash.near_duplicates(table(spark, folder, "documents"), shingle=3, percent=85, bands=30, rows=6)


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; learned where the id's share of 4 is not 2."""
    docs = table(spark, folder, "documents")
    field = langid.fit(docs, share(4) != 2)
    return langid.identify(docs, field).select(
        "doc_id", (share(4) == 2).alias("held_out"), "lang_pred", "score", "n_words", "n_switches"
    )


REPEATS_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, text, {WORDS_SQL} AS w FROM documents),
windows AS (
  SELECT doc_id, text, len(w) AS n, i - 1 AS s, array_to_string(w[i:i + 49], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM docs)),
repeated AS (SELECT g FROM windows GROUP BY g HAVING count(DISTINCT (doc_id, text)) > 1),
found AS (SELECT doc_id, text, n, s FROM windows SEMI JOIN repeated USING (g)),
parted AS (
  SELECT *, sum(CASE WHEN s <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, text ORDER BY s) AS part
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id, text ORDER BY s) AS before FROM found)),
spans AS (SELECT doc_id, text, n, min(s) AS a, max(s) + 50 AS b FROM parted GROUP BY doc_id, text, n, part)
SELECT doc_id, any_value(n)::BIGINT AS n_words, sum(b - a)::BIGINT AS n_repeated, string_agg(a || ':' || b, ',' ORDER BY a) AS spans
FROM spans GROUP BY doc_id, text
"""


@query("op4_suffix_repeats", REPEATS_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of every document that are passages of 50 words and more of another one."""
    return suffixes.repeated_passages(table(spark, folder, "documents"), least=50)


def _rendered_sql(turns: str) -> str:
    return f"list_transform({turns}, lambda t: '<|' || t.role || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10))"


def _mask_sql(side: str) -> str:
    before = f"coalesce(list_sum(list_transform({side}_r[1:i - 1], lambda x: length(x))), 0)"
    first = f"({before} + length({side}_c[i].role) + 5)::BIGINT"
    stop = f"({before} + length({side}_r[i]) - 1)::BIGINT"
    at = f"list_filter(range(1, len({side}_c) + 1), lambda i: {side}_c[i].role = 'assistant')"
    return f"array_to_string(list_transform({at}, lambda i: {first} || ':' || {stop}), ',')"


PREFERENCES_SQL = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS t FROM turns GROUP BY conv_id),
said AS (
  SELECT conv_id, t, t[1] AS opening, coalesce(list_sum(list_transform(t, lambda x: CASE WHEN x.role = 'assistant' THEN length(x.text) ELSE 0 END)), 0) AS said FROM convs),
linked AS (
  SELECT *, lead(conv_id) OVER w AS next_id, lead(t) OVER w AS next_t, lead(said) OVER w AS next_said
  FROM said WINDOW w AS (PARTITION BY opening ORDER BY conv_id)),
alone AS (
  SELECT conv_id, t, p, p[len(p)] AS z FROM (
    SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS p FROM linked WHERE next_id IS NULL) WHERE len(p) > 0),
pairs AS (
  SELECT CASE WHEN next_said > said THEN next_id ELSE conv_id END AS pair_id, CASE WHEN next_said > said THEN conv_id ELSE next_id END AS rejected_id,
    'sibling' AS kind, CASE WHEN next_said > said THEN next_t ELSE t END AS chosen, CASE WHEN next_said > said THEN t ELSE next_t END AS rejected
  FROM linked WHERE next_id IS NOT NULL
  UNION ALL
  SELECT conv_id, conv_id, 'swapped', t[1:z],
    list_concat(t[1:z - 1], [{{'role': 'assistant', 'text': CASE WHEN len(p) > 1 THEN t[p[len(p) - 1]].text ELSE '' END}}]) FROM alone),
prefixed AS (
  SELECT *, len(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[1:i] = rejected[1:i]))::INTEGER AS n FROM pairs),
parts AS (
  SELECT *, chosen[n + 1:] AS chosen_c, rejected[n + 1:] AS rejected_c, {_rendered_sql("chosen[n + 1:]")} AS chosen_r, {_rendered_sql("rejected[n + 1:]")} AS rejected_r
  FROM prefixed)
SELECT pair_id, rejected_id, kind, n AS n_prompt_turns, array_to_string({_rendered_sql("chosen[1:n]")}, '') AS prompt,
  array_to_string(chosen_r, '') AS chosen_text, {_mask_sql("chosen")} AS chosen_mask,
  array_to_string(rejected_r, '') AS rejected_text, {_mask_sql("rejected")} AS rejected_mask
FROM parts
"""


@query("op5_preference_pairs", PREFERENCES_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt and masked completions of the preference pairs of all conversations."""
    return preferences.format_conversations(table(spark, folder, "conversations"))


@query("op6_bpe_roundtrip")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and hashes of ids and decoded bytes of every document."""
    docs = table(spark, folder, "documents")
    coded = bpe.encode_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op7_pii_spans")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and hash of the base spans, and all spans with those that the classifier adds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [F.expr(pii.count_of(k)).alias(f"n_{k}") for k in pii.BASE]
    base = F.sha2(F.expr(pii.spelled("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, F.expr(pii.spelled("found")).alias("spans"))


PLAIN_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
CONTAMINATION_SQL = f"""
WITH items AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS size FROM (SELECT item_id, {PLAIN_SQL} AS w FROM benchmark) WHERE len(w) > 0),
docs AS (SELECT doc_id, {PLAIN_SQL} AS w FROM documents),
doc_grams AS (
  SELECT doc_id, n, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, len(w) AS n, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items))),
item_grams AS (
  SELECT item_id, n, size, g, count(*) AS k
  FROM (SELECT item_id, n, size, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, n - size + 2)) AS i FROM items))
  GROUP BY ALL),
starts AS (
  SELECT DISTINCT doc_id, item_id, n, least(n, doc_n) AS width, size, unnest(range(greatest(1, i - n + size), least(i, greatest(1, doc_n - n + 1)) + 1)) AS s
  FROM (SELECT d.doc_id, d.n AS doc_n, d.i, t.item_id, t.n, t.size FROM doc_grams d JOIN item_grams t ON d.size = t.size AND d.g = t.g)),
window_grams AS (
  SELECT c.doc_id, c.item_id, c.n, c.width, c.size, c.s, d.g, count(*) AS k
  FROM starts c JOIN doc_grams d ON d.doc_id = c.doc_id AND d.size = c.size AND d.i BETWEEN c.s AND c.s + c.width - c.size GROUP BY ALL),
shared AS (
  SELECT w.doc_id, w.item_id, w.width, w.s, w.n + w.width - 2 * w.size + 2 AS total, sum(least(w.k, t.k)) AS common
  FROM window_grams w JOIN item_grams t ON t.item_id = w.item_id AND t.g = w.g GROUP BY ALL),
scored AS (SELECT *, common / (total - common)::DOUBLE AS similarity FROM shared)
SELECT doc_id, item_id, s - 1 AS start_word, width AS n_words, similarity FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""


@query("op8_decontamination", CONTAMINATION_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Best window of each benchmark item in each document that holds it."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_vector_search")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20."""
    return vectors.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op10_edit_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after a series of edits."""
    docs = table(spark, folder, "documents")
    path = public_tokenizers.path(RANK_FILE)
    return edit_counts.count_edited(docs, edit_counts.sample_edits(), path, public_tokenizers.PATTERN)


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spelled_sql(text: str) -> str:
    columns = ("d.doc_id", "d.source", "d.lang", "d.n_chars", text)
    return " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns)


MANIFEST_SQL = f"""
WITH RECURSIVE {CRC_SQL},
leaves AS (
  SELECT d.doc_id, d.lang, coalesce('=' || d.lang, '') AS tree, c.crc % 3 = 0 AS hit,
    sha256({_spelled_sql('d.text')}) AS leaf, sha256({_spelled_sql(f"translate(d.text, '{CAPITALS}', '{CAPITALS.lower()}')")}) AS other
  FROM documents d JOIN crcs c ON c.doc_id = d.doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8, n),
tops AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes WHERE n = 1),
roof AS (
  SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM roof WHERE n > 1 GROUP BY level, i // 8, n),
steps AS (
  SELECT p.tree, p.i, n.level, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < p.i >> (3 * n.level)), '') AS a,
    coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > p.i >> (3 * n.level)), '') AS b
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.n > 1 AND n.i // 8 = p.i >> (3 * n.level + 3) GROUP BY ALL),
roof_steps AS (
  SELECT t.tree, n.level + 1000 AS level, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < t.i >> (3 * n.level)), '') AS a,
    coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > t.i >> (3 * n.level)), '') AS b
  FROM tops t JOIN roof n ON n.n > 1 AND n.i // 8 = t.i >> (3 * n.level + 3) GROUP BY ALL),
ways AS (
  SELECT tree, i, list(a || ',' || b ORDER BY level) AS way
  FROM (SELECT * FROM steps UNION ALL SELECT p.tree, p.i, r.level, r.a, r.b FROM placed p JOIN roof_steps r ON r.tree = p.tree) GROUP BY tree, i)
SELECT p.doc_id, p.lang, p.leaf, t.subroot, r.h AS root, sha256(replace(array_to_string(coalesce(w.way, []), ''), ',', '')) AS proof_sha256,
  list_reduce(coalesce(w.way, []), lambda h, s: sha256(split_part(s, ',', 1) || h || split_part(s, ',', 2)), CASE WHEN p.hit THEN p.other ELSE p.leaf END) AS folded_root,
  folded_root = r.h AS verified
FROM placed p JOIN tops t ON t.tree = p.tree JOIN roof r ON r.n = 1 LEFT JOIN ways w ON w.tree = p.tree AND w.i = p.i
"""


@query("op11_manifest", MANIFEST_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, root and proof of every document, and what tampering with a third of the texts does to the root."""
    return manifest.prove(table(spark, folder, "documents"), manifest.lower_some())


RESAMPLE_SQL = r"""
WITH bytes AS (
  SELECT list(list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS t
  FROM range(256) r(n)),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
worded AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (SELECT side, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (VALUES (1), (2), (3)) r(k)),
features AS (SELECT side, doc_id, array_to_string(w[i:i + k - 1], ' ') AS f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(strlen(f)), lambda j: instr('123456789ABCDEF', substr(h, 2 * j + 1, 1)) * 16 + instr('123456789ABCDEF', substr(h, 2 * j + 2, 1))),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) % 10000 AS b
  FROM (SELECT f, hex(encode(f)) AS h FROM features GROUP BY f), bytes),
counted AS (SELECT x.side, x.doc_id, h.b, sum(x.n) AS n FROM features x JOIN hashed h ON h.f = x.f GROUP BY ALL),
sums AS (SELECT b, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM counted GROUP BY b),
gains AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000)))) AS g
  FROM sums, (SELECT sum(s) AS ss, sum(t) AS tt FROM sums)),
weights AS (SELECT c.doc_id, sum(c.n)::BIGINT AS n_features, sum(c.n * g.g)::BIGINT AS weight FROM counted c JOIN gains g ON g.b = c.b WHERE c.side = 'd' GROUP BY c.doc_id),
scored AS (
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(x.n_features, 0) AS n_features, coalesce(x.weight, 0) AS weight,
    (coalesce(x.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM worded d LEFT JOIN weights x ON x.doc_id = d.doc_id WHERE d.side = 'd'),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, a.r AS rank
FROM scored s LEFT JOIN able a ON a.doc_id = s.doc_id AND a.r <= a.n * 5 // 100
"""


@query("op12_resample", RESAMPLE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Weight and score of every document towards the benchmark's texts, and the ranks of the drawn twentieth."""
    scored = resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return scored.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2,048 tokens."""
    pieces = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
