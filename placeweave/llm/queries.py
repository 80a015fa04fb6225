"""The queries of this subpackage over the driver's tables, and their SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, license_scan, ngram_join, packing, preferences, quality_rules, sentencepiece_bridge, sstable, toxicity, url_rules,
)
from .shared import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its place, number and crc of ids, read back from the shards that were written."""
    path = shared_dir(spark, "sstable")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    sstable.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return sstable.summary(spark, path)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its group of equal texts; the largest identifier stays."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = exact_dedup.deduplicate(docs, keep="max")
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS k, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece of a document its place in the windows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of neighbouring conversations: the even identifier is chosen, the odd one rejected."""
    turns = _table(spark, sf_dir, "conversations").select(
        F.expr("conv_id div 2").alias("pair_id"), F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"),
        "turn", "role", "text",
    )
    pairs = preferences.format_pairs(turns)
    size = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("long")
    trained = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]), F.lit(0))
    return pairs.select(
        "pair_id", F.col("n_prefix").cast("long").alias("n_prefix"),
        size("prompt").alias("prompt_chars"), size("chosen").alias("chosen_chars"), size("rejected").alias("rejected_chars"),
        trained("chosen_spans").alias("chosen_trained"), trained("rejected_spans").alias("rejected_trained"),
        *[F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
    )


OP4_SQL = """
WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, role, text,
             '<|' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) AS head,
             replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT pair_id, least(count(*) FILTER (side = 0), count(*) FILTER (side = 1)) AS both FROM t GROUP BY pair_id),
x AS (SELECT a.pair_id, min(a.i) - 1 AS first FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.i = b.i AND a.side = 0 AND b.side = 1
      WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY a.pair_id),
p AS (SELECT n.pair_id, coalesce(x.first, n.both) AS n_prefix FROM n LEFT JOIN x USING (pair_id)),
s AS (SELECT pair_id, n_prefix,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 0 AND i <= n_prefix), '') AS prompt,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 0 AND i > n_prefix), '') AS chosen,
        coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 1 AND i > n_prefix), '') AS rejected,
        coalesce(sum(length(body)) FILTER (side = 0 AND i > n_prefix AND role = 'assistant'), 0)::BIGINT AS chosen_trained,
        coalesce(sum(length(body)) FILTER (side = 1 AND i > n_prefix AND role = 'assistant'), 0)::BIGINT AS rejected_trained
      FROM t JOIN p USING (pair_id) GROUP BY pair_id, n_prefix)
SELECT pair_id, n_prefix, length(prompt) AS prompt_chars, length(chosen) AS chosen_chars, length(rejected) AS rejected_chars,
       chosen_trained, rejected_trained, sha256(prompt) AS prompt_sha256, sha256(chosen) AS chosen_sha256,
       sha256(rejected) AS rejected_sha256 FROM s
"""


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page the host and path of its url, the listed rule that fits best, and the verdict."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.LISTED + url_rules.PATTERNS).select("page_id", "host", "path", "rule", "verdict")


def _rule_values(rules: list[url_rules.Rule]) -> str:
    quoted = ["(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (r.name, r.regex, r.action)) + ")" for r in rules]
    return ", ".join(quoted)


OP5_SQL = f"""
WITH listed(name, rx, action) AS (VALUES {_rule_values(url_rules.LISTED)}),
patterns(name, rx, action) AS (VALUES {_rule_values(url_rules.PATTERNS)}),
p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
v AS (SELECT page_id, host, path,
  (SELECT name FROM listed WHERE regexp_matches(p.host || p.path, rx) ORDER BY length(name) DESC, name DESC LIMIT 1) AS rule,
  (SELECT action FROM listed WHERE regexp_matches(p.host || p.path, rx) ORDER BY length(name) DESC, name DESC LIMIT 1) AS a,
  (SELECT action FROM patterns WHERE regexp_matches(p.host || p.path, rx) ORDER BY length(name) DESC, name DESC LIMIT 1) AS b
  FROM p)
SELECT page_id, host, path, rule, coalesce(a, b, 'allow') AS verdict FROM v
"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the licence notice that fits best."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select("doc_id", "license", "dice", "n_notices")


def _template_values() -> str:
    rows = [
        "('" + name + "', [" + ", ".join(f"'{g}'" for g in license_scan.bigrams(text)) + "])"
        for name, text in license_scan.TEMPLATES.items()
    ]
    return ", ".join(rows)


def _anchor_values() -> str:
    return ", ".join(f"('{name}', '{pair}', {before}, {n})" for name, pair, before, n in license_scan.anchors(license_scan.TEMPLATES))


OP6_SQL = f"""
WITH templates(name, grams) AS (VALUES {_template_values()}),
spots(name, pair, before, words) AS (VALUES {_anchor_values()}),
c AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\n]+', ' ', 'g') AS t FROM documents),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS i, trim(unnest(l)) AS s FROM (SELECT doc_id, string_split(t, chr(10)) AS l FROM c)),
paragraphs AS (SELECT doc_id, unnest(regexp_split_to_array(t, '\n *\n[ \n]*')) AS s FROM c),
spans AS (SELECT doc_id, trim(regexp_replace(s, '[ \n]+', ' ', 'g')) AS s FROM
          (SELECT doc_id, s FROM lines UNION ALL
           SELECT doc_id, s FROM paragraphs WHERE instr(trim(replace(s, chr(10), '|')), '|') > 0)),
w AS (SELECT row_number() OVER () AS span, doc_id, s, string_split(s, ' ') AS w FROM spans
      WHERE length(s) - length(replace(s, ' ', '')) BETWEEN 1 AND 400),
g AS (SELECT span, doc_id, s, len(w) - 1 AS n, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM w),
m AS (SELECT span, doc_id, s, name, 2.0::DOUBLE * len(list_intersect(g, grams)) / (n + len(grams)) AS dice
      FROM g, templates WHERE n <= 1.5 * len(grams) + 1 AND len(grams) <= 1.5 * n + 1),
best AS (SELECT span, doc_id, s, max(struct_pack(dice := dice, name := name)) AS b FROM m WHERE dice >= {license_scan.LEAST} GROUP BY ALL),
d AS (SELECT doc_id, max(b) AS b, count(*) AS n FROM best GROUP BY doc_id),
rest AS (SELECT doc_id, string_split(string_agg(s, ' ' ORDER BY i), ' ') AS w FROM lines WHERE s <> '' AND (doc_id, s) NOT IN (SELECT (doc_id, s) FROM best) GROUP BY doc_id),
spot AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM rest),
v AS (SELECT DISTINCT spot.doc_id, w[greatest(i - before, 1):greatest(i - before, 1) + words - 1] AS w FROM spot JOIN spots ON w[i] || ' ' || w[i + 1] = pair),
vg AS (SELECT doc_id, len(w) - 1 AS n, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM v),
vm AS (SELECT doc_id, max(struct_pack(dice := 2.0::DOUBLE * len(list_intersect(g, grams)) / (n + len(grams)), name := name)) AS b FROM vg, templates
       WHERE n <= 1.5 * len(grams) + 1 AND len(grams) <= 1.5 * n + 1 GROUP BY doc_id),
x AS (SELECT doc_id, b FROM vm WHERE b.dice >= {license_scan.LEAST})
SELECT doc_id, greatest(d.b, x.b).name AS license, greatest(d.b, x.b).dice AS dice, (coalesce(n, 0) + (x.b IS NOT NULL)::INT)::BIGINT AS n_notices
FROM documents LEFT JOIN d USING (doc_id) LEFT JOIN x USING (doc_id)
"""


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document number and crc of its ids, and whether they are sentencepiece's and decode to the text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bridge.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the base counts and the verdict of base rules and learnt cutoffs."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs, _table(spark, sf_dir, "labels"), carry=["doc_id"])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the score of a model that has not seen the held-out rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the size of its set and the smallest identifier that links reach."""
    return ngram_join.join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] FOR i IN range(1, len(w) - 3)]) END AS g FROM w),
s AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM g),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT doc_id, len(g)::BIGINT AS n_shingles, c AS component_id FROM g JOIN m USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sstable": op1_sstable,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_preferences": op4_preferences,
    "op5_url_rules": op5_url_rules,
    "op6_license_scan": op6_license_scan,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_join": op10_ngram_join,
}
ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op4_preferences": OP4_SQL,
    "op5_url_rules": OP5_SQL,
    "op6_license_scan": OP6_SQL,
    "op10_ngram_join": OP10_SQL,
}
