"""One query per corpus operator over its whole table, and SQL where SQL can express it.

Queries: name -> callable(spark, sf_dir) -> DataFrame. The query of operator N is opN_<name>.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import (
    exact_dedup, html_main, importance, jaccard_join, language_mix, line_dedup, packing, pii,
    prefix_forest, rule_quality, sentencepiece_scan, token_alignment, token_counts,
)
from tabforge.llm.common import id_remainder, table
from tabforge.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
PHONE = r"\+?[0-9]+ ?\([0-9]{3}\) [0-9]{3}-[0-9]{4}"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf):
    """Counts of all documents before and after personal data is masked and a title line added."""
    docs = table(spark, sf, "documents")
    trees = pii.cut(token_counts.segment_trees(docs, BYTE_BPE), "text",
                    f"{pii.PATTERNS['email']}|{PHONE}", "m")

    def masked(value, i):
        start = (F.col("m_at")[i] + F.length(F.col("m_gaps")[i])).cast("int")
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.when(
            F.contains(value, F.lit("@")), "<email>").otherwise("<phone>").alias("replacement"))

    title = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.concat(
        F.lit("Document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.lit("\n"))
        .alias("replacement"))
    # From the last place to the first, so that earlier places stay valid.
    edits = F.concat(F.reverse(F.transform("m_found", masked)), F.array(title))
    out = token_counts.apply_edits(trees.withColumn("edits", edits).drop(
        "m_found", "m_gaps", "m_at"), BYTE_BPE)
    return out.select("doc_id", F.col("n_before").alias("n_tokens"), "n_edits",
                      F.col("n_tokens").alias("n_tokens_edited"), "encoded_chars",
                      F.length("text").alias("n_chars_edited"))


@query
def op2_html_extraction(spark, sf):
    out = html_main.extract(table(spark, sf, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                      "n_blocks")


@query
def op3_sentencepiece(spark, sf):
    """Ids of all documents, and whether they decode to the text again, per chunk."""
    encoded = sentencepiece_scan.encode(table(spark, sf, "documents"), PIECE_BPE)
    numbers = encoded.withColumns({
        "n_tokens": (F.length("ids") / 4).cast("long"), "ids_crc32": F.crc32("ids")})
    decoded = sentencepiece_scan.decode(numbers, PIECE_BPE, ["n_tokens", "ids_crc32"])
    return decoded.select("doc_id", "chunk", "chunks", "n_tokens", "ids_crc32",
                          F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
                          F.length("text").alias("n_chars"))


@query
def op4_exact_dedup(spark, sf):
    out = exact_dedup.exact_duplicates(table(spark, sf, "documents"))
    return out.withColumnRenamed("digest", "text_sha256")


ORACLES["op4_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""


@query
def op5_jaccard_join(spark, sf):
    return jaccard_join.similar_components(table(spark, sf, "documents"), width=4, num=85, den=100)


ORACLES["op5_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) END) AS sh FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b
  ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id
  WHERE 100 * p.i >= 85 * (x.n + y.n - p.i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT r.a AS doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON r.a = n.doc_id GROUP BY r.a
"""


def languages(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Train on the rows that are not held out, predict all."""
    held = id_remainder(id_col, 3) == 1
    model = language_mix.train(documents.filter(~held))
    return language_mix.predict(documents, model, id_col).withColumn(
        "held_out", id_remainder("doc_id", 3) == 1)


@query
def op6_language_id(spark, sf):
    out = languages(table(spark, sf, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "languages", "shares")


@query
def op7_line_dedup(spark, sf):
    """Per document its lines and which go: line:document:line:distance of the earliest one."""
    out = line_dedup.dedup_report(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.expr(
        "array_join(transform(dropped, d -> concat_ws(':', d.line, d.keep_doc, d.keep_line, "
        "d.distance)), ' ')").alias("dropped"))


ORACLES["op7_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, line, string_split_regex(regexp_replace(lower(raw), '^\s+|\s+$', '', 'g'), '\s+')
    AS ws, {'d': doc_id, 'l': line} AS me FROM l),
k AS MATERIALIZED (SELECT * FROM w WHERE len(ws) >= 3),
f AS MATERIALIZED (SELECT ws, min(me) AS me FROM k GROUP BY ws),
v AS MATERIALIZED (
  SELECT me, unnest(list_transform(range(1, len(ws) + 1), lambda i: {'at': i,
    'key': list_concat(ws[1:i - 1], ws[i + 1:])}), recursive := true)
  FROM f WHERE len(ws) >= 10),
o AS (SELECT me, ws AS key FROM f WHERE len(ws) >= 10),
near AS (
  SELECT a.me, b.me AS first FROM v a JOIN v b ON a.key = b.key AND a.at = b.at AND b.me < a.me
  UNION SELECT o.me, v.me FROM o JOIN v ON o.key = v.key AND v.me < o.me
  UNION SELECT v.me, o.me FROM v JOIN o ON o.key = v.key AND o.me < v.me),
gone AS (
  SELECT k.me, f.me AS first, 0 AS distance FROM k JOIN f ON k.ws = f.ws AND f.me <> k.me
  UNION ALL SELECT me, min(first), 1 FROM near GROUP BY me),
g AS (SELECT me.d AS doc_id, count(*) AS n, string_agg(concat_ws(':', me.l, first.d, first.l,
  distance), ' ' ORDER BY me.l) AS dropped FROM gone GROUP BY me.d)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10)))::INT AS n_lines,
       coalesce(g.n, 0)::INT AS n_dropped, coalesce(g.dropped, '') AS dropped
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query
def op8_nearest_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return prefix_forest.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on labelled rows that are not held out, score all."""
    held = id_remainder("doc_id", 4) == 2
    stats = materialize(rule_quality.statistics(documents))
    marks = labels.select("doc_id", F.col("quality").alias("label"))
    model = rule_quality.train(stats.filter(~held).join(marks, "doc_id"))
    return rule_quality.score(stats, model).withColumn("held_out", held)


@query
def op9_quality_classifier(spark, sf):
    out = quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def packed(documents: DataFrame) -> DataFrame:
    """Pieces of all documents with their place; ids are kept as a checksum only."""
    pieces = packing.tokenised_pieces(documents, BYTE_BPE)
    pieces = materialize(pieces.select("doc_id", "piece", "start", "length",
                                       F.crc32("ids").alias("ids_crc32")))
    return packing.pack(pieces)


@query
def op10_best_fit_packing(spark, sf):
    return packed(table(spark, sf, "documents"))


@query
def op11_importance_resampling(spark, sf):
    return importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# Bytes of UTF-8 from code points, CRC-32 over them with a table of 256 entries made by its rule.
ORACLES["op11_importance_resampling"] = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
t AS (SELECT true AS raw, row_number() OVER () AS no, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
w AS MATERIALIZED (SELECT raw, no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM t),
f AS MATERIALIZED (SELECT raw, no, unnest(list_concat(ws,
    list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS s FROM w),
b AS MATERIALIZED (SELECT s, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(s, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
      WHEN unicode(c) < 2048 THEN [192 + unicode(c) // 64, 128 + unicode(c) % 64]
      WHEN unicode(c) < 65536 THEN [224 + unicode(c) // 4096, 128 + unicode(c) // 64 % 64, 128 + unicode(c) % 64]
      ELSE [240 + unicode(c) // 262144, 128 + unicode(c) // 4096 % 64, 128 + unicode(c) // 64 % 64,
        128 + unicode(c) % 64] END))),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT s FROM f), tab),
n AS (SELECT bucket, count(*) FILTER (WHERE raw) AS s, count(*) FILTER (WHERE NOT raw) AS t
  FROM f JOIN b USING (s) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(((t + CAST(1 AS DOUBLE)) * (sum(s) OVER () + 10000)) /
  ((s + CAST(1 AS DOUBLE)) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM n),
d AS (SELECT no, count(*) AS n_features, sum(gain) AS weight FROM f JOIN b USING (s) JOIN g USING (bucket)
  WHERE raw GROUP BY no),
z AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || coalesce(CAST(w.doc_id AS VARCHAR), ''))[1:8] AS BIGINT)
    + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS noise FROM w LEFT JOIN d USING (no) WHERE raw),
r AS (SELECT *, weight + noise AS score, n_words >= 20 AS able, row_number() OVER (PARTITION BY n_words >= 20
  ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS total FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * total // 100 THEN place END AS rank FROM r
"""


@query
def op12_token_alignment(spark, sf):
    return token_alignment.token_links(table(spark, sf, "documents"), BYTE_BPE, PIECE_BPE)


@query
def op13_pii(spark, sf):
    """Terms near an entity, as in the SQL, and those anywhere in a text that holds it."""
    return pii.report(pii.spans_of(table(spark, sf, "documents"), everywhere=True, near=True))


def _pii_sql() -> str:
    """Base spans line by line, then the terms near them by their counts on all lines."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    word = r"[\p{L}\p{N}]+"
    kinds = " UNION ALL ".join(
        f"SELECT row, pos, line, {i} AS kind, string_split_regex(line, '{p}') AS gaps, "
        f"regexp_extract_all(line, '{p}') AS vs FROM l" for i, p in enumerate(patterns.values()))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l0 AS (SELECT row, unnest(range(len(ls))) AS no, unnest(ls) AS line FROM d),
l AS MATERIALIZED (SELECT row, no, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY row ORDER BY no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM l0),
k AS ({kinds}),
p AS (SELECT row, pos, line, kind, unnest(range(1, len(vs) + 1)) AS i, gaps, vs FROM k WHERE len(vs) > 0),
q AS (SELECT row, pos, line, kind, vs[i] AS v, gaps[i] AS before, gaps[i + 1] AS after,
  list_sum(list_transform(range(1, i + 1), lambda j: length(gaps[j]) + CASE WHEN j < i THEN length(vs[j]) ELSE 0 END)) AS b,
  regexp_replace(vs[i], '[^0-9]+', '', 'g') AS n FROM p),
m AS MATERIALIZED (SELECT *, b + length(v) AS e, CASE kind WHEN 0 THEN lower(v) WHEN 1 THEN 'ip:' || v
    WHEN 2 THEN 'card:' || n ELSE 'phone:' || n END AS entity FROM q WHERE CASE kind
  WHEN 0 THEN true
  WHEN 1 THEN list_min(list_transform(string_split(v, '.'), lambda x: length(ltrim(x, '0')) <= 3
    AND TRY_CAST(x AS HUGEINT) <= 255)::INT[]) = 1
  WHEN 2 THEN length(n) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda j:
    CASE WHEN (length(n) - j) % 2 = 0 THEN CAST(n[j] AS INTEGER)
      ELSE CAST(n[j] AS INTEGER) * 2 - CASE WHEN n[j] >= '5' THEN 9 ELSE 0 END END)) % 10 = 0
  ELSE length(n) BETWEEN 9 AND 15 END),
c AS (SELECT row, pos, line, entity, b - length(before) AS s0, CASE WHEN length(before) > 160
    THEN regexp_replace(right(before, 160), '^{word}', '') ELSE before END AS side, length(before) AS whole, true AS lead FROM m
  UNION ALL SELECT row, pos, line, entity, e, CASE WHEN length(after) > 160
    THEN regexp_replace(left(after, 160), '{word}$', '') ELSE after END, 0, false FROM m),
c2 AS (SELECT row, pos, line, entity, CASE WHEN lead THEN s0 + whole - length(side) ELSE s0 END AS s0,
  string_split_regex(side, '{patterns["email"]}|{word}') AS gaps, regexp_extract_all(side, '{patterns["email"]}|{word}') AS vs FROM c),
o0 AS (SELECT row, pos, line, entity, s0, gaps, vs, unnest(range(1, len(vs) + 1)) AS i FROM c2 WHERE len(vs) > 0),
o AS MATERIALIZED (SELECT row, pos, line, entity, lower(vs[i]) AS term, pos + s0 + list_sum(list_transform(range(1, i + 1),
    lambda j: length(gaps[j]) + CASE WHEN j < i THEN length(vs[j]) ELSE 0 END)) AS b, length(vs[i]) AS size FROM o0
  WHERE regexp_full_match(vs[i], '{word}') AND regexp_matches(vs[i], '\p{{L}}')),
tl AS (SELECT term, count(*) AS n_term FROM (SELECT unnest(list_distinct(list_filter(
  string_split_regex(lower(line), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))) AS term FROM l) GROUP BY term),
en AS (SELECT entity, count(DISTINCT (row, pos)) AS n_entity FROM m GROUP BY entity),
pr AS (SELECT entity, term, count(DISTINCT (row, pos)) AS n_pair FROM o GROUP BY entity, term
  HAVING count(DISTINCT line) >= 2),
told AS (SELECT entity, term FROM (SELECT *, CAST((SELECT count(*) FROM l) AS DOUBLE) AS n FROM pr
  JOIN en USING (entity) JOIN tl USING (term)) WHERE ln(n / n_entity) > 0
  AND least(ln(n_pair * n / (n_entity * n_term)) / ln(n / n_entity), 1) >= 0.9),
sp AS (SELECT row, kind, pos + b AS b, pos + e AS e FROM m),
ts AS (SELECT DISTINCT row, b, b + size AS e FROM o JOIN told USING (entity, term)),
al AS (SELECT * FROM sp UNION ALL SELECT row, 4, b, e FROM ts WHERE NOT EXISTS (
  SELECT 1 FROM sp WHERE sp.row = ts.row AND sp.b < ts.e AND ts.b < sp.e)),
x AS (SELECT row, kind, b, e, concat_ws(':', (['email', 'ip', 'card', 'phone', 'term'])[kind + 1], b, e) AS t FROM al),
r AS (SELECT row, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip,
  count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
  count(*) FILTER (WHERE kind = 4) AS n_term, string_agg(t, ',' ORDER BY kind, b) FILTER (WHERE kind < 4) AS base,
  string_agg(t, ',' ORDER BY kind, b) AS spans FROM x GROUP BY row)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, coalesce(n_term, 0) AS n_term, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (row)
"""


ORACLES["op13_pii"] = _pii_sql()
