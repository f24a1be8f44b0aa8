"""URL judgements: host and path rules first, gradient-boosted trees on lexical features for the rest.

Training needs labelled URLs. Suffix statistics (share of blocked URLs per hashed host suffix and per hashed
path segment) count every labelled row; the trees are fitted on at most ``MAX_TRAIN`` of them, chosen by a hash of the URL.
The statistics have a fixed number of buckets, so their tables may be broadcast.

Defined results: a null URL, or one without "://", has an empty host and path, fits no rule and is judged by its (zero)
features; with labels of one kind only, every URL gets that kind; with no labels every URL is allowed; repeated URLs
get equal results; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.common import saved

#: (host and path prefix, verdict); the longest rule that fits wins.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
MAX_TRAIN = 20_000
BUCKETS = 1024
SMOOTHING = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy",
    "parameters", "query_length", "fragment", "suffix_rate", "suffix_count", "segment_rate", "segment_count",
)


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the URL's host or a parent of it and whose path starts the URL's path; else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules=RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for name, said in rules:
        verdict = F.when(rule == name, F.lit(said)).otherwise(verdict)
    return verdict


def _entropy(text: Column) -> Column:
    """Bits per character of the character distribution."""
    n = F.length(text)
    terms = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: n - F.length(F.replace(text, c, F.lit(""))),
    )
    bits = F.aggregate(terms, F.lit(0.0), lambda s, k: s - F.when(k > 0, (k / n) * F.log2(k / n)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """df with _host, _path, two statistics buckets and the features that need no statistics."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    d = df.withColumn("_host", host_of(url)).withColumn("_path", path_of(url))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    suffix = F.substring_index("_host", ".", -3)
    segment = F.regexp_extract("_path", r"^/([^/]*)", 1)
    ratio = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    values = {
        "url_length": F.length(url),
        "host_length": F.length("_host"),
        "path_length": F.length("_path"),
        "depth": F.regexp_count("_path", F.lit("/[^/]+")),
        "labels": F.when(F.length("_host") > 0, F.regexp_count("_host", F.lit(r"\.")) + 1).otherwise(0),
        "digit_ratio": ratio(F.regexp_count(url, F.lit("[0-9]")), F.length(url)),
        "hyphens": F.regexp_count("_host", F.lit("-")),
        "entropy": _entropy(url),
        "parameters": F.regexp_count(query, F.lit("[^&]+")),
        "query_length": F.length(query),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
    }
    return d.withColumns(
        {f"_{k}": v.cast("double") for k, v in values.items()}
        | {
            "_suffix": F.pmod(F.xxhash64(suffix), F.lit(BUCKETS)).cast("int"),
            "_segment": F.pmod(F.xxhash64(F.lit("segment"), segment), F.lit(BUCKETS)).cast("int"),
        }
    )


@dataclass
class UrlModel:
    """Statistics per bucket (a few thousand rows at most) and the fitted trees; ``constant`` without two kinds of labels."""

    statistics: list[tuple[str, int, float, float]]
    prior: float
    trees: GBTClassificationModel | None
    constant: float

    def _with_rates(self, df: DataFrame) -> DataFrame:
        for kind in ("suffix", "segment"):
            rows = [(b, r, c) for k, b, r, c in self.statistics if k == kind]
            stats = df.sparkSession.createDataFrame(rows, f"_{kind} int, _{kind}_rate double, _{kind}_count double")
            # At most BUCKETS rows.
            df = df.join(F.broadcast(stats), f"_{kind}", "left")
            df = df.withColumn(f"_{kind}_rate", F.coalesce(f"_{kind}_rate", F.lit(self.prior)))
            df = df.withColumn(f"_{kind}_count", F.log1p(F.coalesce(f"_{kind}_count", F.lit(0.0))))
        return VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_vector").transform(df)

    def block_scores(self, df: DataFrame, url_col: str = "url") -> DataFrame:
        """df with _host, _path and block_score, the probability that the URL is to be blocked."""
        d = lexical(df, url_col)
        if self.trees is None:
            return d.select(*[F.col(f"`{c}`") for c in df.columns], "_host", "_path", F.lit(self.constant).alias("block_score"))
        scored = self.trees.transform(self._with_rates(d))
        return scored.select(
            *[F.col(f"`{c}`") for c in df.columns], "_host", "_path",
            vector_to_array("_probability")[1].alias("block_score"),
        )


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", max_rows: int = MAX_TRAIN) -> UrlModel:
    """Fit on URLs labelled 1 (block) or 0 (allow); rows with a null label are left out."""
    rows = lexical(labelled.where(F.col(label_col).isNotNull()).select(F.col(url_col), F.col(label_col).cast("double").alias("_label")), url_col)
    total = rows.agg(F.count("*").alias("n"), F.sum("_label").alias("bad")).head()
    n, bad = total["n"], total["bad"] or 0.0
    if not n or bad in (0.0, float(n)):
        return UrlModel([], 0.0, None, 1.0 if n and bad else 0.0)
    prior = bad / n
    statistics = []
    for kind in ("suffix", "segment"):
        for r in rows.groupBy(f"_{kind}").agg(F.sum("_label").alias("bad"), F.count("*").alias("n")).collect():  # <= BUCKETS rows
            statistics.append((kind, r[0], float((r["bad"] + SMOOTHING * prior) / (r["n"] + SMOOTHING)), float(r["n"])))
    model = UrlModel(statistics, prior, None, prior)
    # A hash of the URL and the row's place, so that one URL repeated often can't exceed the bound.
    chance = F.pmod(F.xxhash64(F.col(url_col), F.monotonically_increasing_id()), F.lit(1_000_000)) < int(1e6 * min(1.0, max_rows / n))
    sample = saved(model._with_rates(rows.where(chance)).select("_vector", "_label"), "url-sample")
    kinds = sample.select("_label").distinct().count()  # at most two
    if kinds == 2:
        fitter = GBTClassifier(
            featuresCol="_vector", labelCol="_label", predictionCol="_prediction", maxIter=12, maxDepth=4, stepSize=0.3, seed=11
        )
        fitter.setProbabilityCol("_probability").setRawPredictionCol("_raw")
        model.trees = fitter.fit(sample.coalesce(4))
    return model


def judge(df: DataFrame, model: UrlModel, url_col: str = "url", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """df with host, path, rule, verdict and block_score."""
    rule = fitting_rule(F.col("_host"), F.col("_path"), rules)
    scored = model.block_scores(df, url_col).withColumn("_rule", rule)
    verdict = F.coalesce(rule_verdict(F.col("_rule"), rules), F.when(F.col("block_score") >= threshold, "block").otherwise("allow"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("host", "path", "rule", "verdict", "block_score")]
    return scored.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict"), "block_score")


def rule_labels(df: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """url and blocked (1 or 0) of the URLs that a rule decides: the labelled URLs the trees learn from."""
    url = F.col(url_col)
    said = rule_verdict(fitting_rule(host_of(url), path_of(url), rules), rules)
    return df.select(url, F.when(said.isNotNull(), (said == "block").cast("int")).alias("blocked")).where("blocked is not null")
