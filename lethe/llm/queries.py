"""The check queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.llm import (
    decontaminate, edittokens, linededup, maxsketch, packing, qualityrules, secretscan, simhash, suffixdedup, toxicity, wavelet, whitening, wrappers)
from lethe.llm.common import table
from lethe.llm.tokens import default_vocabulary
from lethe.scratch import scratch_path


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write(table(spark, sf_dir, "documents"), path, default_vocabulary())
    return wavelet.digests(wavelet.read(spark, path))


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(
        decontaminate.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


def op4_secretscan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), secretscan.Ledger(spark, scratch_path(spark, "ledger"))
    secretscan.update(docs, ledger)
    return secretscan.digests(secretscan.findings(docs, ledger))


def op6_qualityrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.digests(qualityrules.run(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.digests(toxicity.classify(docs, labels))


def op7_edittokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count every document, replace each number of four digits or more, and count again by the edits."""
    trees = edittokens.build(table(spark, sf_dir, "documents").select("doc_id", "text"), default_vocabulary())
    before = trees.withColumn("n_tokens_before", F.col("n_tokens"))
    after = edittokens.apply(edittokens.replacing(before, "[0-9]{4,}", "<num>"), default_vocabulary())
    return after.select("doc_id", "n_tokens_before", "n_edits", "n_reencoded", F.col("n_tokens").alias("n_tokens_after"), F.size("leaves").alias("n_leaves"))


def op8_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(suffixdedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.run(table(spark, sf_dir, "documents"), default_vocabulary())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.assign(table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.run(table(spark, sf_dir, "embeddings"))


def op12_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.run(table(spark, sf_dir, "pages"))


def op13_maxsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    maxsketch.build(table(spark, sf_dir, "documents"), path)
    return maxsketch.search(spark, path, table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_wavelet": op1_wavelet,
    "op2_linededup": op2_linededup,
    "op3_decontaminate": op3_decontaminate,
    "op4_secretscan": op4_secretscan,
    "op5_toxicity": op5_toxicity,
    "op6_qualityrules": op6_qualityrules,
    "op7_edittokens": op7_edittokens,
    "op8_suffixdedup": op8_suffixdedup,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_wrappers": op12_wrappers,
    "op13_maxsketch": op13_maxsketch,
}


def _secrets_sql() -> str:
    """Positions of matches from the lengths of matches and of the pieces between them, one part for each rule."""
    parts = []
    for place, rule in enumerate(secretscan.RULES):
        # Letters in either case, spelled out: the other engine folds more than ASCII.
        pattern = re.sub(r"\(\?i:(.*?)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", rule.pattern)
        quoted = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least,
            regexp_extract_all(text, {quoted}) AS m, string_split_regex(text, {quoted}) AS p,
            regexp_extract_all(text, {quoted}, {rule.group}) AS v FROM d""")
    base = ", ".join(f"'{r.kind}'" for r in secretscan.BASE)
    span = "kind || ':' || (stop - own) || ':' || stop, ',' ORDER BY stop - own, place"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        found AS ({" UNION ALL ".join(parts)}),
        spans AS (
          SELECT doc_id, kind, place, length(m[i]) AS own,
            list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS stop
          FROM found, unnest(range(1, len(m) + 1)) AS t(i) WHERE length(v[i]) >= least),
        by_doc AS (
          SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secretscan.BASE)},
            string_agg({span}) FILTER (kind IN ({base})) AS base, string_agg({span}) AS spans
          FROM spans GROUP BY doc_id)
        SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secretscan.BASE)},
          sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN by_doc USING (doc_id)"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLES: dict[str, str] = {
    "op4_secretscan": _secrets_sql(),
    "op2_linededup": r"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
          FROM documents),
        filled AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS following
          FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        hits AS (
          SELECT *, following IS NOT NULL AND row_number() OVER (PARTITION BY line, following ORDER BY doc_id, k) > 1 AS again,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > 50 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, k) > 1 AS alone
          FROM filled),
        covered AS (SELECT *, alone OR again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY k), false) AS gone FROM hits),
        runs AS (
          SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), false) AS begins FROM covered),
        merged AS (
          SELECT lines.*, coalesce(gone, false) AS gone, coalesce(begins, false) AS begins
          FROM lines LEFT JOIN runs USING (doc_id, pos))
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(g, 0)::BIGINT AS n_deleted, coalesce(r, 0)::BIGINT AS n_runs,
          sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN (
          SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS g, count(*) FILTER (begins) AS r,
            string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept
          FROM merged GROUP BY doc_id) USING (doc_id)""",
    "op3_decontaminate": rf"""
        WITH words AS (
          SELECT doc_id AS id, false AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
          UNION ALL
          SELECT item_id, true, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
        widths AS (SELECT DISTINCT least(len(w), 10) AS n FROM words WHERE item AND len(w) > 0),
        windows AS (
          SELECT id, item, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
          FROM words, widths, unnest(range(1, len(w) - n + 2)) AS t(i)
          WHERE NOT item OR n = least(len(w), 10)),
        hits AS (
          SELECT DISTINCT d.id AS doc_id, d.i, d.n, b.id AS item_id
          FROM windows d JOIN windows b ON d.words = b.words AND d.n = b.n AND b.item AND NOT d.item),
        hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
        items AS (
          SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
        SELECT id AS doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
          sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit_words h ON h.doc_id = id LEFT JOIN items t ON t.doc_id = id WHERE NOT item""",
    "op13_maxsketch": rf"""
        WITH words AS (
          SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS w FROM documents),
        docs AS (SELECT row, doc_id, len(w) AS n, w FROM words WHERE len(w) > 0),
        items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term FROM benchmark),
        sums AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS length FROM docs),
        counts AS (
          SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM docs)
          WHERE term IN (SELECT term FROM items) GROUP BY row, term),
        weights AS (
          SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM counts, sums GROUP BY term, n_docs),
        scored AS (
          SELECT item_id, row,
            sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // length))))::BIGINT AS score
          FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN docs USING (row), sums GROUP BY item_id, row),
        ranked AS (
          SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
          FROM scored JOIN docs USING (row) WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {maxsketch.K}""",
}
