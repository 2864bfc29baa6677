"""URL filter: rules, and logistic regression on hashed character n-grams of host and path.

The model is trained from a small labelled table of URLs (``LABELLED``; at most ``MAX_LABELLED`` rows), by
gradient descent whose sums are DataFrame aggregates; the driver holds ``1 << BITS`` weights.  N-grams of
host and path are told apart; digits count as one character.  Scoring is an expression over each URL.

Null URLs and those without ``://`` have an empty host and path and are judged by the bias alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS, GRAMS = 12, (3, 4, 5)
STEPS, STEP, L2 = 40, 30.0, 1e-4
MAX_LABELLED = 10_000
THRESHOLD = 0.5

#: Verdict, host and path of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_BAD = (
    "casino win", "casino bonus", "cheap pills", "pills online", "free bets", "best bets", "adult x", "adult cams", "spam farm", "link spam",
    "ads track", "track ads", "poker jackpot", "lottery prize", "xxx video", "warez crack", "payday loan", "replica watch", "malware load",
    "phishing bank",
)
_GOOD = (
    "city library", "old town", "weather report", "garden notes", "history museum", "open school", "river trail", "science news", "music hall",
    "travel guide", "health office", "recipe book", "sports club", "photo archive", "council minutes", "student union", "bakery house", "the other",
    "station", "reading", "nation", "theatre", "northern", "hartland", "winter", "tindall", "shelton", "anders", "thornton", "withers", "stanton",
    "interest", "printing", "thin", "tension", "marine", "linden", "berlin", "orchard", "heather", "tenor", "onset", "inland", "western",
)


def labelled(spark: SparkSession) -> DataFrame:
    """``url`` and ``label`` (1: to be blocked)."""
    sites = [(w, 1) for w in _BAD] + [(w, 0) for w in _GOOD]
    urls = []
    for k, (name, label) in enumerate(sites):
        for j, joint in enumerate(("-", "")):
            front, end = ("", "www.", "blog.", "m.")[(k + j) % 4], ("com", "net", "org")[(k + 2 * j) % 3]
            lang, tail = ("en", "de", "fr", "es")[(k + j) % 4], ("", "/", ".html", "?page=2")[(k + 3 * j) % 4]
            urls.append((f"http://{front}{joint.join(name.split())}.example.{end}/{lang}/{17 * k + j}{tail}", label))
    return spark.createDataFrame(urls, "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    known = F.locate("://", url) > 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    return tuple(F.coalesce(F.when(known, c), F.lit("")) for c in (host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as ``rule`` and ``verdict``; null if none does."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    given = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip((*r, r[1] + r[2]), ("verdict", "host", "path", "rule"), strict=True))) for r in longest_first))
    fits = lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"])
    return F.get(F.filter(given, fits), F.lit(0))


def features(host: Column, path: Column) -> Column:
    """Buckets of the n-grams, repeats included; bucket 0 is left to the bias."""

    def grams(kind: str, text: Column, n: int) -> Column:
        marked = F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]", "0"), F.lit("$"))
        at = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - n + 1)).otherwise(F.array().cast("array<int>"))
        hashed = lambda t: F.transform(at, lambda i: 1 + F.pmod(F.xxhash64(F.lit(kind), F.substring(t, i, F.lit(n))), F.lit((1 << BITS) - 1)))
        return F.transform(F.array(marked), hashed)[0]

    return F.concat(*(grams(k, t, n) for k, t in (("h", host), ("p", path)) for n in GRAMS))


def margin(buckets: Column, weights: Sequence[float]) -> Column:
    """Log-odds; n-grams count by their share."""
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.element_at(w, (b + 1).cast("int")))
    return F.lit(float(weights[0])) + F.when(F.size(buckets) > 0, total / F.sqrt(F.size(buckets))).otherwise(0.0)


def train(table: DataFrame) -> list[float]:
    """The weights, bias first, after ``STEPS`` steps down the gradient over ``table`` (``url``, ``label``)."""
    n = table.limit(MAX_LABELLED + 1).count()
    if n > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    weights = [0.0] * (1 << BITS)
    # One partition for a table of bounded size: then a step needs no shuffle.
    rows = table.select("label", features(*host_and_path(F.col("url"))).alias("buckets")).coalesce(1).cache()
    for _ in range(STEPS if n else 0):
        off = (1 / (1 + F.exp(-margin(F.col("buckets"), weights))) - F.col("label")) / n
        share = off / F.sqrt(F.greatest(F.size("buckets"), F.lit(1)))
        parts = rows.select(F.inline(F.concat(F.array(F.struct(F.lit(0).cast("long").alias("b"), off.alias("g"))), F.transform("buckets", lambda b: F.struct(b.alias("b"), share.alias("g"))))))
        for r in parts.groupBy("b").agg(F.sum("g").alias("g")).collect():  # 1 << BITS at most
            weights[r.b] -= STEP / 10 * r.g if r.b == 0 else STEP * (r.g + L2 * weights[r.b])
    rows.unpersist()
    return weights


def judge(pages: DataFrame, weights: Sequence[float], rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score``."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumns({"host": host, "path": path})
    h, p = F.col("host"), F.col("path")
    scored = parsed.withColumns({"_ruled": ruled(h, p, rules), "block_score": 1 / (1 + F.exp(-margin(features(h, p), weights)))})
    by_model = F.when(F.col("block_score") >= THRESHOLD, "block").otherwise("allow")
    return scored.withColumns({"rule": F.col("_ruled.rule"), "verdict": F.coalesce("_ruled.verdict", by_model)}).drop("_ruled")
