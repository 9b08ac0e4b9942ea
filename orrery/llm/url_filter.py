"""URL filtering: host and path rules, and boosted trees where no rule fits.

Rules are (host, path, verdict) rows. A rule fits its host and all subdomains if
the url's path starts with the rule's path; the longest fitting rule decides.
Urls without a rule get the verdict of gradient-boosted trees over lexical
features: lengths, depth, digit ratio, character entropy, parameter counts and
statistics of the host's suffix. The trees are trained from labelled urls.

The suffix statistics are block rates among the labelled urls, smoothed, for the
host's last label and its last two; a url is described by the statistics of the
other labelled urls only (its own label is left out), so training sees what
scoring will see.

Defined results. Null url or one without ``://``: host and path empty, no rule,
judged by the trees. A port, empty ones included, is no part of a suffix. No labels or a single class among them: the method's
verdict is that class, or allow. Repeated rows are judged each; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import MAX_BROADCAST_ROWS, ascii_lower, materialise, sample_order
from orrery.operators.skew import HOT_SHARE

#: (host, path, verdict) of the registered query's rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Labelled urls that the trees are trained on, at most; statistics use all.
SAMPLE = 20_000
TREES, DEPTH = 12, 3
SMOOTH = 5.0
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "entropy", "n_params", "n_hyphens", "n_symbols", "has_fragment", "is_https", "last_rate", "two_rate", "last_share",
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    some = F.coalesce(at > 0, F.lit(False))
    return ascii_lower(F.when(some, host).otherwise("")), F.when(some, path).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _entropy(text: Column) -> Column:
    """Bits per character over the characters of a string."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars)
    # Runs of the sorted characters: each distinct one weighs by its count.
    counts = F.transform(
        F.array_distinct(chars), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    )
    bits = F.aggregate(
        counts, F.lit(0.0), lambda a, k: a - (k / n) * F.log2(k.cast("double") / n)
    )
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame, key: str) -> DataFrame:
    """``key``, host, path, suffixes and the lexical features of column url."""
    host, path = parts(F.col("url"))
    split = urls.select(key, F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    count = lambda c, p: F.regexp_count(c, F.lit(p)).cast("double")
    size = F.greatest(F.length("url"), F.lit(1))
    return split.select(
        key,
        "host",
        "path",
        F.regexp_extract("host", r"([^.:]*)(:\d*)?$", 1).alias("last"),
        F.regexp_extract("host", r"([^.]*\.[^.:]*)(:\d*)?$", 1).alias("two"),
        F.length("url").cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        count("path", "/").alias("depth"),
        count("host", r"\.").alias("host_labels"),
        (count("url", r"\d") / size).alias("digit_ratio"),
        (count("host", r"\d") / F.greatest(F.length("host"), F.lit(1))).alias("host_digit_ratio"),
        _entropy(F.col("url")).alias("entropy"),
        count("url", "[?&][^=&]*=").alias("n_params"),
        count("host", "-").alias("n_hyphens"),
        count("url", "[%_~@]").alias("n_symbols"),
        F.col("url").contains("#").cast("double").alias("has_fragment"),
        F.col("url").startswith("https").cast("double").alias("is_https"),
    )


def _rates(known: DataFrame, suffix: str) -> DataFrame:
    """Labelled urls and blocked ones per suffix."""
    return known.groupBy(suffix).agg(F.count("*").alias(f"{suffix}_n"), F.sum("label").alias(f"{suffix}_bad"))


def _with_rates(df: DataFrame, rates: DataFrame, suffix: str, n: int) -> DataFrame:
    """``df`` with the counts of its suffix, null for one that no labelled url has.

    ``rates`` is broadcast if it is small. Else its frequent suffixes are, which are
    fewer than HOT_SHARE, and only urls of the others are shuffled.
    """
    if rates.count() <= MAX_BROADCAST_ROWS:
        return df.join(F.broadcast(rates), suffix, "left")
    is_hot = F.col(f"{suffix}_n") > n // HOT_SHARE
    hot, cold = F.broadcast(rates.where(is_hot)), rates.where(~is_hot)
    others = df.join(F.broadcast(hot.select(suffix)), suffix, "left_anti")
    return df.join(hot, suffix).unionByName(others.join(cold, suffix, "left"))


def classify(urls: DataFrame, labelled: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, host, path, p_block and verdict of every row, by the trees alone.

    ``labelled`` has columns url and label (1: block).
    """
    known = labelled.withColumn("id", F.xxhash64("url")).select("id", "url", "label")
    known = materialise(
        lexical(known.select(F.struct("id", "label").alias("k"), "url"), "k").select("k.id", "k.label", "*").drop("k"),
        "labelled-urls",
    )
    total = known.agg(F.count("*").alias("n"), F.sum("label").alias("bad")).first()
    n, bad = total["n"], total["bad"] or 0
    base = bad / n if n else 0.0
    plain = lexical(urls, key)
    if not 0 < bad < n:
        constant = F.lit(float(bool(bad)))
        return plain.select(key, "host", "path", constant.alias("p_block"), F.when(constant > 0.5, "block").otherwise("allow").alias("verdict"))
    last, two = materialise(_rates(known, "last"), "last-rates"), materialise(_rates(known, "two"), "two-rates")

    def described(df: DataFrame, own: Column, own_bad: Column) -> DataFrame:
        df = _with_rates(_with_rates(df, last, "last", n), two, "two", n)
        for s in ("last", "two"):
            seen, blocked = F.coalesce(f"{s}_n", F.lit(0)) - own, F.coalesce(f"{s}_bad", F.lit(0)) - own_bad
            df = df.withColumn(f"{s}_rate", (blocked + SMOOTH * base) / (seen + SMOOTH))
        return df.withColumn("last_share", F.coalesce("last_n", F.lit(0)) / float(n))

    sample = known.orderBy(sample_order("url_length", "id"), "id").limit(SAMPLE)
    train = described(materialise(sample, "url-sample"), F.lit(1), F.col("label"))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=5, cacheNodeIds=False
    ).fit(vector.transform(materialise(train.select("label", *FEATURES), "url-features")))
    scored = trees.transform(vector.transform(described(plain, F.lit(0), F.lit(0))))
    p = vector_to_array("probability")[1]
    return scored.select(key, "host", "path", p.alias("p_block"), F.when(p >= 0.5, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block of every row.

    The trees learn from the urls that the rules decide.
    """
    host, path = parts(F.col("url"))
    fit = rule_of(host, path, rules)
    ruled = pages.select("url", fit.alias("r")).where("r is not null")
    labelled = ruled.select("url", (F.col("r.verdict") == "block").cast("int").alias("label"))
    found = classify(pages.select("page_id", "url"), labelled)
    fits = rule_of(F.col("host"), F.col("path"), rules)
    return found.withColumn("r", fits).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "verdict").alias("verdict"), "p_block"
    )
