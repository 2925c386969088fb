"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Labels: pages that a rule fits carry its verdict. The trees (Spark ML) are trained on at most ``TRAIN_ROWS`` of them, the first by
a hash of the url; numbers about suffixes are counted over all pages. Everything is DataFrame expressions and Spark ML.

Null url, or one without ``://``: empty host and path, no rule, the trees' verdict on empty features. Without labelled pages, or
with labels all alike, there are no trees and the verdict is that label, or allow. Ties and repeated rows: equal urls get
equal verdicts. An empty table gives an empty result. Extra columns pass through; columns of the result's names are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigloom.llm.sample import first_by_hash
from contigloom.session import settle

#: (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with its own; the longest wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
         ("block", "net", "/fr/"))
TRAIN_ROWS = 4000
TREES, DEPTH = 10, 4
FEATURES = ("url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "entropy", "n_parameters",
            "query_length", "has_fragment", "is_https", "has_dash", "suffix_share", "suffix_hosts", "suffix_digits")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` (A-Z in lower case) and ``path``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    return pages.withColumns({"host": F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER),
                              "path": F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)})


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The text of the rule that fits, and its verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    text = verdict = F.lit(None).cast("string")
    for kind, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, host + path).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character over letters, digits and everything else, by the counts of 38 kinds of characters."""
    low, n = F.lower(text), F.greatest(F.length(text), F.lit(1)).cast("double")
    total, known = F.lit(0.0), F.lit(0)
    for c in _LOWER + "0123456789":
        k = F.length(low) - F.length(F.replace(low, F.lit(c), F.lit("")))
        known = known + k
        total = total - F.when(k > 0, k / n * F.log2(k / n)).otherwise(0.0)
    other = F.length(low) - known
    return total - F.when(other > 0, other / n * F.log2(other / n)).otherwise(0.0)


def with_features(pages: DataFrame) -> DataFrame:
    """Lexical features of each url, with host and path at hand; suffix statistics over all ``pages``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"[?]([^#]*)", 1)
    rows = with_parts(pages).withColumns({
        "suffix": F.substring_index(F.col("host"), ".", -1),
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "host_depth": F.length("host") - F.length(F.translate("host", ".", "")),
        "path_depth": F.length("path") - F.length(F.translate("path", "/", "")),
        "digit_ratio": (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(F.concat("host", "path")),
        "n_parameters": F.when(query == "", 0).otherwise(F.length(query) - F.length(F.translate(query, "&", "")) + 1),
        "query_length": F.length(query), "has_fragment": url.contains("#").cast("int"),
        "is_https": url.startswith("https://").cast("int"), "has_dash": F.col("host").contains("-").cast("int")})
    # per host first, so a hot suffix is summed from few rows
    hosts = rows.groupBy("suffix", "host").agg(F.count("*").alias("n"), F.sum("digit_ratio").alias("digits"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), F.sum("digits").alias("digits"))
    total = suffixes.agg(F.sum("n").alias("total"))
    stats = suffixes.join(F.broadcast(total)).select(  # one row
        "suffix", F.log(F.col("n") / F.col("total")).alias("suffix_share"),
        F.log1p(F.col("hosts")).alias("suffix_hosts"), (F.col("digits") / F.col("n")).alias("suffix_digits"))
    return rows.join(stats, "suffix")


def train(labelled: DataFrame, limit: int = TRAIN_ROWS) -> GBTClassificationModel | str:
    """Trees from rows with the features and ``label`` (1 block, 0 allow); a plain verdict if the labels are all alike."""
    some = settle(first_by_hash(labelled.select("url", "label", *FEATURES), "url", limit))
    kinds = {r["label"]: r["count"] for r in some.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return "block" if 1.0 in kinds else "allow"
    # both labels weigh the same, so how often the rules block is no evidence against a url without one
    weight = F.when(F.col("label") == 1.0, 0.5 / kinds[1.0]).otherwise(0.5 / kinds[0.0]) * sum(kinds.values())
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(some.repartition(2).withColumn("weight", weight))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, minInstancesPerNode=5, weightCol="weight").fit(rows.select("label", "features", "weight"))


def judge(rows: DataFrame, model: GBTClassificationModel | str) -> DataFrame:
    """Rows with the features, and ``block_probability``: the trees', or 0 or 1 from a plain verdict."""
    if isinstance(model, str):
        return rows.withColumn("block_probability", F.lit(float(model == "block")))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return model.transform(rows).withColumn("block_probability", vector_to_array("probability")[1])


def url_filter(pages: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block) and block_probability."""
    made = ("host", "path", "rule", "verdict", "block_probability", "suffix", "label", "features", "rawPrediction", "probability", "prediction", *FEATURES)
    own = [c for c in pages.columns if c not in made]
    rows = with_features(pages.select(*own))
    rule, verdict = rule_columns()
    rows = rows.withColumns({"rule": rule, "ruled_": verdict})
    labelled = rows.filter("ruled_ is not null").withColumn("label", (F.col("ruled_") == "block").cast("double"))
    found = judge(rows, train(labelled))
    decided = F.coalesce("ruled_", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return found.select(*own, "host", "path", "rule", decided.alias("verdict"), "block_probability")
