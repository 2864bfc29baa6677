"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import (
    decontaminate,
    language_model,
    lexical,
    licenses,
    lines,
    mixing,
    nearest,
    quality,
    rules,
    runs,
    simhash,
    substrings,
    urls,
)
from fleetlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE["op9_decontaminate"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), tests AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM tests WHERE len(w) > 0)
), starts AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM wanted))
), hits AS (
  SELECT doc_id, item_id, i, k FROM starts JOIN wanted USING (k, phrase)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", "text")


ORACLE["op10_line_templates"] = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
), numbered AS (
  SELECT doc_id, text, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM split
), parsed AS (
  SELECT *, list_filter(regexp_split_to_array(regexp_replace(line, '[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*', '<*>', 'g'), '[ \t\x0B\f\r]+'), lambda t: t <> '') AS w
  FROM numbered
), leaved AS (
  SELECT *, len(w) AS n, array_to_string(w, ' ') AS template, concat(len(w), ':', array_to_string(w[1:3], ' ')) AS leaf,
    CASE WHEN len(w) > 0 THEN md5(array_to_string(w[1:3], ' ')) END AS head
  FROM parsed
), lows AS (
  SELECT doc_id, list_sort(list(DISTINCT head[1:8])) AS low_0, list_sort(list(DISTINCT head[9:16])) AS low_1, list_sort(list(DISTINCT head[17:24])) AS low_2
  FROM leaved WHERE head IS NOT NULL GROUP BY doc_id
), placed AS (
  SELECT *, CASE WHEN head[1:8] = low_0[1] THEN low_0[2] ELSE low_0[1] END AS around_0,
    CASE WHEN head[9:16] = low_1[1] THEN low_1[2] ELSE low_1[1] END AS around_1,
    CASE WHEN head[17:24] = low_2[1] THEN low_2[2] ELSE low_2[1] END AS around_2
  FROM leaved LEFT JOIN lows USING (doc_id)
), lines AS (
  SELECT * FROM placed WHERE n >= 3
), alike AS (
  SELECT template FROM (SELECT template, text, min(around_0) AS a, min(around_1) AS b, min(around_2) AS c FROM lines GROUP BY template, text) GROUP BY template
  HAVING count(*) >= 5 AND greatest(count(DISTINCT a), count(DISTINCT b), count(DISTINCT c)) >= greatest(5, 0.4 * count(a))
), mixed AS (
  SELECT * FROM lines WHERE n >= 6 AND leaf IN (
    SELECT leaf FROM lines WHERE n >= 6 GROUP BY leaf HAVING count(DISTINCT text) >= 5 AND count(DISTINCT template) > 1)
), counted AS (
  SELECT leaf, n, place, token, count(*) AS c FROM (SELECT leaf, n, unnest(range(1, n + 1)) AS place, unnest(w) AS token FROM mixed) GROUP BY ALL
), fixed AS (
  SELECT leaf, n, place, max_by(token, c) AS token FROM counted GROUP BY leaf, n, place HAVING max(c) * 2 > sum(c)
), general AS (
  SELECT leaf, count(*) AS places FROM fixed GROUP BY leaf, n HAVING count(*) - 3 >= 0.6 * (n - 3)
), fitting AS (
  SELECT m.doc_id, m.line_no, m.text, m.leaf, m.around_0, m.around_1, m.around_2 FROM mixed m JOIN general g USING (leaf) JOIN fixed f USING (leaf)
  GROUP BY m.doc_id, m.line_no, m.text, m.leaf, m.around_0, m.around_1, m.around_2, g.places HAVING count(*) FILTER (m.w[f.place] = f.token) = g.places
), general_recurring AS (
  SELECT leaf FROM (SELECT leaf, text, min(around_0) AS a, min(around_1) AS b, min(around_2) AS c FROM fitting GROUP BY leaf, text) GROUP BY leaf
  HAVING count(*) >= 5 AND greatest(count(DISTINCT a), count(DISTINCT b), count(DISTINCT c)) >= greatest(5, 0.4 * count(a))
), dropped AS (
  SELECT doc_id, line_no FROM lines WHERE template IN (FROM alike)
  UNION SELECT doc_id, line_no FROM fitting WHERE leaf IN (FROM general_recurring)
), kept AS (
  SELECT p.doc_id, count(*) AS n_lines, count(d.line_no) AS n_dropped,
    coalesce(string_agg(p.line, chr(10) ORDER BY p.line_no) FILTER (d.line_no IS NULL), '') AS text
  FROM placed p LEFT JOIN dropped d USING (doc_id, line_no) GROUP BY p.doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, kept.text
FROM documents LEFT JOIN kept USING (doc_id)
"""


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.train(docs, labels.where(quality.fold() != 0))
    scored = quality.score(docs.select("doc_id", "text"), weights).select("row.doc_id", "score")
    return scored.select(
        "doc_id", (quality.fold() == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


@query
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op3_substrings"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY phrase) AS n FROM windows) WHERE n > 1
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM again
), numbered AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT n.doc_id, count(*) AS n_words, count(r.p) AS n_removed, string_agg(word, ' ' ORDER BY n.p) FILTER (r.p IS NULL) AS left_over
  FROM numbered n LEFT JOIN removed r USING (doc_id, p) GROUP BY n.doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


@query
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.language_scores(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.array_union(base, F.coalesce("template_labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


@query
def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.train(urls.labelled(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The texts that operator 12 is asked about: of some documents the words from one on repeat a cycle."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    )
    cut = chosen.withColumns({"n": F.size("w").cast("long"), "g": F.floor(F.col("h") / 10)}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("tail", F.col("n") - F.col("a")).withColumn("p", F.floor(F.col("tail") / (3 + F.col("g") % 8)) + 1)
    whole = lambda c: F.col(c).cast("int")
    cycle = F.slice("w", whole("a") + 1, whole("p"))
    repeated = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(F.col("tail") / F.col("p")).cast("int"))), F.lit(1), whole("tail"))
    words = F.concat(F.slice("w", F.lit(1), whole("a")), repeated)
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    rank = lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))
    best = F.array_min(F.transform("runs", rank))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.floor(F.lit(-1000) * F.col("best.l") / F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_ranked_search"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), totals AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM words WHERE len(w) > 0
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), counted AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN weighed USING (term) JOIN counted USING (term), totals GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""


@query
def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op13_top_products"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""
