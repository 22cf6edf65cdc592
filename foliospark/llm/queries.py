"""The operators as queries over the whole tables, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import (
    filter_audit,
    html_extract,
    lang_id,
    line_dedup,
    merkle,
    mixing,
    near_vectors,
    quality,
    sentencepiece_codec,
    simhash,
    toxicity,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_mixing"] = """
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
ranked AS (
  SELECT *, coalesce('s' || source, 'n') AS k,
         row_number() OVER (PARTITION BY source ORDER BY size DESC, md5(doc_id::VARCHAR)) AS r
  FROM sized),
sources AS (SELECT k, max(source) AS source, sum(size)::BIGINT AS source_size FROM ranked GROUP BY k),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::INT + 1] AS w,
         2.0::DOUBLE * source_size AS room
  FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
             - coalesce(sum(room) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY room / w, source IS NULL, source)),
targets AS (
  SELECT k, source_size, CASE WHEN room <= level * w THEN room
         ELSE (SELECT arg_min(level, room / w) FROM levels WHERE room > level * w) * w END AS target
  FROM levels),
rated AS (
  SELECT doc_id, size, source_size, target, r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('17:' || k), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS offs
  FROM ranked JOIN targets USING (k))
SELECT doc_id, size, source_size, target,
       ((floor(r * rate + offs) - floor((r - 1) * rate + offs))::BIGINT * size)::BIGINT AS taken
FROM rated
"""


@query
def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.round_trip(table(spark, sf, "documents"), model)


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    network = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, network).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = line_dedup.remove_repeats(docs, counted=True)
    return out.select("doc_id", "n_lines_deleted", F.sha2("text", 256).alias("text_sha256"))


ORACLES["op8_line_dedup"] = """
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE doc_id IS NOT NULL),
lines AS (
  SELECT doc_id, pos, trim(raw, E'\\t\\x0b\\x0c\\r ') AS line,
         len(regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM split WHERE trim(raw, E'\\t\\x0b\\x0c\\r ') <> ''),
placed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lines),
wide AS (
  SELECT doc_id, pos, upto - words AS origin, upto,
         list(line) OVER f AS next_lines, max(pos) OVER f AS stop, max(upto) OVER f AS stop_upto,
         list(line) OVER b AS last_lines, min(pos) OVER b AS start, min(upto - words) OVER b AS start_at
  FROM placed
  WINDOW f AS (PARTITION BY doc_id ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
         b AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
runs AS (
  SELECT doc_id, pos AS start, stop, md5(array_to_string(next_lines, chr(10))) AS content
  FROM wide WHERE stop_upto - origin >= 50
  UNION
  SELECT doc_id, start, pos, md5(array_to_string(last_lines, chr(10))) FROM wide WHERE upto - start_at >= 50),
later AS (
  SELECT doc_id, start, stop, row_number() OVER (PARTITION BY content ORDER BY doc_id, start) AS n FROM runs),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS pos FROM later WHERE n > 1),
kept AS (
  SELECT s.doc_id, string_agg(s.raw, chr(10) ORDER BY s.pos) AS text FROM split s
  LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos WHERE g.pos IS NULL GROUP BY s.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_lines_deleted,
       sha256(CASE WHEN c.n IS NULL THEN d.text ELSE coalesce(k.text, '') END) AS text_sha256
FROM documents d LEFT JOIN counts c ON d.doc_id = c.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query
def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op9_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, sf, "documents"))


S_ = "\\x20\\x09-\\x0D"
LEAF_SQL = f"[{S_}]*(?:[^{S_}]*[^{S_}.!?][{S_}]+){{0,3}}[^{S_}]+[{S_}]*"


def _fingerprint_sql(text: str) -> str:
    """The fingerprint of the SQL expression `text`."""
    cut = lambda joined: (
        f"list_filter(list_transform(string_split({joined}, '|'), lambda x: trim(x)), lambda x: x <> '')"
    )
    return f"""(
  SELECT md5(array_to_string(list_transform(ds, lambda d: md5(d)), '')) || ' ' ||
         array_to_string(list_transform(list_zip(ds, ts), lambda z: 'S' || substr(md5(z[1]), 1, 8) || ' ' || z[2]), ' ')
  FROM (
    SELECT {cut("array_to_string(list_transform(ps, lambda p: p.d || CASE WHEN p.d < '4' THEN '|' ELSE ' ' END), '')")} AS ds,
           {cut("array_to_string(list_transform(ps, lambda p: 'P' || substr(p.d, 1, 8) || ' ' || p.l || CASE WHEN p.d < '4' THEN '|' ELSE ' ' END), '')")} AS ts
    FROM (
      SELECT list_transform(
        list_transform(string_split({text}, chr(10)), lambda line: list_transform(
          CASE WHEN len(regexp_extract_all(line, '{LEAF_SQL}')) > 0
               THEN regexp_extract_all(line, '{LEAF_SQL}') ELSE [line] END, lambda x: md5(x))),
        lambda m: {{'d': md5(array_to_string(m, '')), 'l': array_to_string(list_transform(m, lambda y: substr(y, 1, 6)), ' ')}}) AS ps)))"""


def _likeness_sql(a: str, b: str) -> str:
    leaves = lambda fp: f"list_distinct(list_filter(string_split({fp}, ' '), lambda t: length(t) = 6))"
    return (
        f"CASE WHEN substr({a}, 1, 32) = substr({b}, 1, 32) THEN 1.0::DOUBLE ELSE "
        f"2 * len(list_intersect({leaves(a)}, {leaves(b)}))::DOUBLE / (len({leaves(a)}) + len({leaves(b)})) END"
    )


ORACLES["op9_merkle"] = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
printed AS (SELECT *, {_fingerprint_sql("text")} AS fp FROM texts),
led AS (
  SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text,
         coalesce(lead(fp) OVER o, first_value(fp) OVER o) AS next_fp
  FROM printed WINDOW o AS (ORDER BY doc_id DESC)),
edited AS (
  SELECT *, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) AS edited FROM led),
both_ AS (SELECT *, {_fingerprint_sql("edited")} AS efp FROM edited)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint,
       efp AS edited_fingerprint, {_likeness_sql("fp", "efp")} AS near_edited,
       {_likeness_sql("fp", "next_fp")} AS near_next
FROM both_
"""


@query
def op1_lang_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = lang_id.train(docs.select("doc_id", "lang", "text"))
    return lang_id.identify(docs, model).select(
        "doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous", "second"
    )


@query
def op2_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"))


@query
def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"))


@query
def op3_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf, "embeddings"))


@query
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


ORACLES["op11_filter_audit"] = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
marked AS (
  SELECT t.doc_id, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM texts t LEFT JOIN (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id) l ON t.doc_id = l.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
grouped AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t
  FROM marked GROUP BY part, failed),
met AS (
  SELECT *, CASE WHEN failed = '' THEN 6
                 ELSE list_min([strpos(filter_order, f) FOR f IN string_split(failed, '')]) END AS gone
  FROM grouped, orders),
steps AS (
  SELECT part, filter_order, s.step::INT AS step, substr(filter_order, s.step::INT, 1) AS letter,
         sum(CASE WHEN gone > s.step THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN gone = s.step THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone < s.step AND contains(failed, substr(filter_order, s.step::INT, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = substr(filter_order, s.step::INT, 1) THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN gone = s.step THEN g ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN gone = s.step THEN t ELSE 0 END)::BIGINT AS toxic_lost
  FROM met, (SELECT unnest(range(1, 6)) AS step) s
  GROUP BY part, filter_order, s.step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM steps
"""


@query
def op12_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))
