"""The registered query of each operator, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import (
    bpe,
    decontaminate,
    language_id,
    lm_scoring,
    periodic_runs,
    quality_resample,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    whitening,
)
from orrery.llm.common import read_table

#: The vocabulary file of the BPE query; a parameter, never copied.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read_table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return lm_scoring.cross_entropy_difference(read_table(spark, sf_dir, "documents"), good)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op6_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return bpe.digest(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(read_table(spark, sf_dir, "documents"), order=periodic_runs.planted_order)
    return periodic_runs.digest(found)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_later_copies(read_table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_simhash,
        op3_sharding,
        op4_lm_scoring,
        op5_url_filter,
        op6_quality_resample,
        op7_byte_bpe,
        op8_quality_rules,
        op9_toxicity,
        op10_decontamination,
        op11_periodic_runs,
        op12_substring_dedup,
        op13_whitening,
    )
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Results with model verdicts, encodings or row placement have no SQL form; their
#: queries are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op10_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS k
 FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT rid, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
 FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT rid, s, pos.n, item_id FROM pos JOIN win ON win.k = pos.k AND win.n = pos.n),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM occ)) GROUP BY rid),
own AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT rid, item_id AS i FROM occ) GROUP BY rid),
tok AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
cf AS (SELECT word, count(*) AS cf FROM tok GROUP BY 1),
rare AS (SELECT q, item_id, n, word, row_number() OVER (PARTITION BY q ORDER BY coalesce(cf, 0), word) AS k
 FROM (SELECT DISTINCT q, item_id, n, word FROM (SELECT row_number() OVER () AS q, item_id, len(w) AS n, unnest(w) AS word FROM b)) LEFT JOIN cf USING (word)),
few AS (SELECT *, count(*) OVER (PARTITION BY q) AS terms FROM rare WHERE k <= 4),
meet AS (SELECT a.rid, f.q, f.item_id, a.pos, f.terms, count(DISTINCT o.word) AS met FROM few f JOIN tok a ON a.word = f.word AND f.k = 1
 JOIN few o ON o.q = f.q JOIN tok t ON t.rid = a.rid AND t.word = o.word AND abs(t.pos - a.pos) < f.n GROUP BY ALL),
nearby AS (SELECT rid, count(DISTINCT item_id) AS n_near FROM meet WHERE met = terms GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_near, 0) AS n_near, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN own USING (rid) LEFT JOIN nearby USING (rid)""",
}
