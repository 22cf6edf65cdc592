"""URL filter: host and path rules, and boosted trees for what no rule decides.

The trees see lexical features of the whole url (lengths, depth, digit ratio, entropy, counts
of parameters and signs) and statistics of the host's suffix. They learn from a bounded sample of
the urls that a rule labels. Everything is column expressions and Spark's own trees.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.binding import bind, let
from foliospark.operators.skew import lookup_join
from foliospark.session import cut_lineage

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Holds for `host` and all its subdomains, where the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)
#: Labelled urls the trees may learn from: those with the smallest hash.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 12, 3, 3
#: Pseudo-count of the overall share in the share of one suffix.
SMOOTHING = 20.0
LEXICAL = (
    "url_length host_length path_length query_length depth host_labels digit_ratio host_digit_ratio"
    " upper_ratio entropy parameters hyphens percent_signs dots has_fragment is_https ends_in_slash"
).split()
SUFFIX = ("suffix_share", "suffix_log_count")


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> Column:
    """struct(host, path): the host lower-cased; both empty for null or without `://`."""
    cut = lambda c: F.substring_index(F.substring_index(c, "?", 1), "#", 1)

    def parts(u: Column) -> Column:
        rest = cut(F.substring(u, F.locate("://", u) + 3, F.length(u)))
        host = F.substring_index(rest, "/", 1)
        return F.struct(
            _lower_ascii(host).alias("host"),
            F.substring(rest, F.length(host) + 1, F.length(rest)).alias("path"),
        )

    none = F.struct(F.lit("").alias("host"), F.lit("").alias("path"))
    whole = F.coalesce(url, F.lit(""))
    return let(whole, lambda u: F.when(F.locate("://", u) > 0, parts(u)).otherwise(none))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does. Of rules of equal
    length the first given wins."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    n = F.length(url)
    count = lambda c, what: (F.length(c) - F.length(F.translate(c, what, ""))).cast("double")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    digits = "0123456789"
    query = F.when(F.locate("?", url) > 0, F.substring_index(F.substring(url, F.locate("?", url) + 1, n), "#", 1))
    query = F.coalesce(query, F.lit(""))

    def entropy(u: Column) -> Column:
        chars = F.split(u, "")
        share = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / F.length(u)
        shares = F.transform(F.array_distinct(chars), share)
        bits = F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
        return F.when(F.length(u) > 0, bits).otherwise(0.0)

    return {
        "url_length": n.cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "query_length": F.length(query).cast("double"),
        "depth": count(path, "/"),
        "host_labels": F.when(F.length(host) > 0, count(host, ".") + 1).otherwise(0.0),
        "digit_ratio": ratio(count(url, digits), n),
        "host_digit_ratio": ratio(count(host, digits), F.length(host)),
        "upper_ratio": ratio(count(url, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), n),
        "entropy": let(url, entropy),
        "parameters": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(0.0),
        "hyphens": count(url, "-"),
        "percent_signs": count(url, "%"),
        "dots": count(url, "."),
        "has_fragment": (F.locate("#", url) > 0).cast("double"),
        "is_https": F.startswith(url, F.lit("https://")).cast("double"),
        "ends_in_slash": F.endswith(path, F.lit("/")).cast("double"),
    }


def described(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, suffix, rule, ruled, features…): one row per page, no shuffle."""
    url = F.coalesce(F.col("url"), F.lit("")).alias("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url)
    rows = bind(rows.withColumn("parts", url_parts(F.col("url"))), ["parts"])
    rows = rows.select("page_id", "url", "parts.host", "parts.path")
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    return rows.select(
        "page_id",
        "url",
        "host",
        "path",
        F.substring_index("host", ".", -1).alias("suffix"),
        F.col("found.rule").alias("rule"),
        F.col("found.verdict").alias("ruled"),
        *(features[name].alias(name) for name in LEXICAL),
    )


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """(suffix, suffix_share, suffix_log_count): smoothed share of blocked among the labelled
    urls of a suffix, and the logarithm of all its urls. Counts are combined before the shuffle."""
    blocked = F.when(F.col("ruled") == BLOCK, 1.0).when(F.col("ruled") == ALLOW, 0.0)
    each = rows.groupBy("suffix").agg(
        F.coalesce(F.sum(blocked), F.lit(0.0)).alias("blocked"), F.count("ruled").alias("labelled"), F.count(F.lit(1)).alias("n")
    )
    total = each.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    share = total.select(F.when(F.col("l") > 0, F.col("b") / F.col("l")).otherwise(0.5)).scalar()
    return each.select(
        "suffix",
        ((F.col("blocked") + SMOOTHING * share) / (F.col("labelled") + SMOOTHING)).alias("suffix_share"),
        F.log1p(F.col("n").cast("double")).alias("suffix_log_count"),
    )


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(rows)


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> GBTClassificationModel | float:
    """Boosted trees from labelled rows of `described` with suffix statistics; where the sample
    has one class only, its share of blocked (0 without any labelled row)."""
    label = (F.col("ruled") == BLOCK).cast("double").alias("label")
    order = F.xxhash64(F.lit(SEED), "url")
    sample = (
        rows.where("ruled IS NOT NULL")
        .orderBy(order, "page_id")
        .limit(sample_rows)
        .select(*LEXICAL, *SUFFIX, label)
    )
    # the fit passes over it many times
    known = cut_lineage(_assembled(sample).select("features", "label"))
    n, blocked = known.agg(F.count("label"), F.sum("label")).first()
    if not n or blocked in (0.0, float(n)):
        return float(blocked or 0.0) / max(n, 1)
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32).fit(known)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict, score.

    The longest fitting rule decides; where none fits, the trees' score (share of blocked) does.
    Null urls and urls without `://` have an empty host and path and are judged by the trees.
    Repeated rows stay, other columns are not read, an empty table gives no rows. Whatever share of
    the urls one suffix holds, its statistics are one row copied to sub-keys that occur.
    """
    # read and described once; what follows passes over numbers
    rows = cut_lineage(described(pages, rules))
    rows = lookup_join(rows, suffix_statistics(rows), ["suffix"], ["url"])
    model = train(rows)
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )
