"""The operators applied to their whole tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .chaining import repeated_passages
from .common import BLANKS, LOWER, UPPER, table
from .exact_dedup import exact_dedup
from .langid import identify
from .licences import scan_licences
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .packing import pack_documents
from .periodic import periodic_runs
from .resampling import importance_resample
from .sharding import shard_by_bytes
from .simhash import simhash_groups
from .substrings import dedup_substrings


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_substrings(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_sources(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "copies"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def repeating(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where a checksum of the identifier says which texts repeat a
    stretch of theirs up to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", BLANKS), lambda w: w != ""))
    of = docs.select("doc_id", "text", h.alias("h")).select("*", words.alias("words"), F.floor(F.col("h") / 10).alias("g"))
    of = of.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    of = of.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    place = lambda i: F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")
    woven = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - F.lit(1).cast("long")), lambda i: F.get("words", place(i)))
    return of.select("doc_id", F.when(F.col("n") > 0, F.array_join(woven, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    found = periodic_runs(repeating(table(spark, sf_dir, "documents"))).withColumn("best", best)
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(length * 1000 / period).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"))
    base, more = F.col("phrases.label"), F.col("notices.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("notices.share"), F.lit(0.0)))
    return found.select("doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min("phrases.word").alias("first_word"),
                        F.array_max("phrases.word").alias("last_word"), joined(base).alias("base_labels"),
                        joined(F.concat(base, more)).alias("labels"), score.alias("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_substring_dedup, op3_packing, op4_ann, op5_line_dedup, op6_exact_dedup,
                              op7_sharding, op8_simhash, op9_mixing, op10_language_id,
                              op11_importance_resampling, op12_periodic_runs, op13_licence_scan)}

ORACLE: dict[str, str] = {
    "op5_line_dedup": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
        r AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS r FROM l),
        -- lines repeated as they are
        same AS (SELECT r, min({'d': doc_id, 'p': pos}) AS first FROM r WHERE len(r) > 0 GROUP BY r
                 HAVING count(DISTINCT doc_id) >= 4 OR count(DISTINCT doc_id) >= 2 AND length(array_to_string(r, ' ')) >= 40),
        copies AS (SELECT doc_id, pos FROM r JOIN same USING (r) WHERE {'d': doc_id, 'p': pos} <> first),
        -- lines with a template: fields are tokens with digits, and tokens that fewer than 4 documents have there
        m AS (SELECT doc_id, pos, list_transform(r, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t
              FROM r WHERE len(r) >= 3),
        p AS (SELECT doc_id, pos, t, {'n': len(t), 'head': t[1:3]} AS leaf FROM m
              WHERE len(list_filter(t, lambda x: x = '<*>')) <= len(t) - 0.8 * len(t)),
        leaves AS (SELECT leaf FROM p GROUP BY leaf HAVING count(DISTINCT doc_id) >= 4),
        lines AS (SELECT leaf, t, count(DISTINCT doc_id) AS n FROM p JOIN leaves USING (leaf) GROUP BY ALL),
        tokens AS (SELECT leaf, t, n, unnest(t) AS token, generate_subscripts(t, 1) AS "at" FROM lines),
        frequent AS (SELECT leaf, "at", token FROM tokens GROUP BY leaf, "at", token HAVING sum(n) >= 4),
        general AS (SELECT x.leaf, x.t, any_value(x.n) AS n, list(coalesce(f.token, '<*>') ORDER BY x."at") AS sign
                    FROM tokens x LEFT JOIN frequent f ON x.leaf = f.leaf AND x."at" = f."at" AND x.token = f.token GROUP BY x.leaf, x.t),
        signed AS (SELECT * FROM general WHERE len(list_filter(sign, lambda x: x <> '<*>')) >= 0.8 * len(sign)),
        weighed AS (SELECT leaf, sign, sum(n) AS s FROM signed GROUP BY ALL),
        main AS (SELECT leaf, max_by(sign, {'s': s, 'sign': sign}) AS main FROM weighed GROUP BY leaf),
        template AS (SELECT leaf, t, CASE WHEN len(list_filter(list_zip(sign, main),
                         lambda z: z[1] <> z[2] AND z[1] <> '<*>' AND z[2] <> '<*>')) = 0 THEN main ELSE sign END AS template
                     FROM signed JOIN main USING (leaf)),
        placed AS (SELECT template, doc_id, pos FROM p JOIN template USING (leaf, t)),
        recurring AS (SELECT template, min({'d': doc_id, 'p': pos}) AS first FROM placed GROUP BY template HAVING count(DISTINCT doc_id) >= 4),
        gone AS (SELECT doc_id, pos FROM placed JOIN recurring USING (template) WHERE {'d': doc_id, 'p': pos} <> first
                 UNION SELECT doc_id, pos FROM copies),
        kept AS (SELECT l.doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(g.pos) AS INTEGER) AS n_dropped,
                        coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
                 FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
        SELECT doc_id, n_lines, n_dropped, CAST(length(text) AS INTEGER) AS kept_chars, sha256(text) AS kept_sha256 FROM kept""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
        FROM d""",
}
