"""URL verdicts: rules on host and path, and boosted trees on lexical features.

The urls that a rule decides are the labelled ones. Gradient-boosted trees learn
from them what blocked urls look like (lengths, depth, digits, entropy,
parameters, how often a host suffix is blocked) and judge the rest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tierlake.llm.common import materialise, small_side, uniform

#: The rules of the registered query.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
#: Bound of the labelled sample that the trees are fitted on.
FIT_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "host_digit_ratio", "entropy",
            "parameters", "hyphens", "has_fragment", "secure", "suffix1_rate", "suffix1_seen", "suffix2_rate", "suffix2_seen"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: then up to ``?``, ``#`` or the end. Both empty without ``://`` or for NULL."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits (of equal length the least), else NULL. A rule fits its
    host and subdomains if the path starts with the rule's."""
    result = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):  # the last one wins
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        result = F.when(fits, F.lit(rule)).otherwise(result)
    return result


@F.pandas_udf(DoubleType())
def _entropy(texts: pd.Series) -> pd.Series:
    """Bits per byte."""
    def of(text: str | None) -> float:
        counts = np.bincount(np.frombuffer((text or "").encode(), np.uint8))
        share = counts[counts > 0] / max(1, counts.sum())
        return float(-(share * np.log2(share)).sum())

    return texts.map(of)


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the lexical features that need no labels, and the host suffixes."""
    url = F.coalesce("url", F.lit(""))

    def count(text: Column, of: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(of), F.lit("")))

    def digits(text: Column) -> Column:
        return (F.length(text) - F.length(F.translate(text, "0123456789", ""))) / F.greatest(F.length(text), F.lit(1))

    query = F.when(F.contains(url, F.lit("?")), F.regexp_extract(F.substring_index(url, "#", 1), r"\?(.*)", 1)).otherwise(F.lit(""))
    host, path = F.col("host"), F.col("path")
    return pages.withColumns({
        "url_length": F.log1p(F.length(url)), "host_length": F.length(host).cast("double"), "path_length": F.log1p(F.length(path)),
        "labels": (count(host, ".") + 1).cast("double"), "depth": count(path, "/").cast("double"),
        "digit_ratio": digits(url), "host_digit_ratio": digits(host), "entropy": _entropy(url),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1).cast("double"), "hyphens": count(host, "-").cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"), "secure": F.startswith(F.lower(url), F.lit("https://")).cast("double"),
        "suffix1": F.substring_index(host, ".", -1), "suffix2": F.substring_index(host, ".", -2)})


def judge(pages: DataFrame, rules: dict[str, str] = RULES, fit_rows: int = FIT_ROWS, seed: int = 42) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, p_block``.

    ``pages`` has ``page_id, url``; other columns are ignored. ``rule`` is the rule
    that decides, or NULL; then the boosted trees give the ``verdict`` (block from
    0.5 up) and ``p_block``.

    - NULL urls and urls without ``://`` have an empty host and path, fit no rule
      and are judged by the method. Repeated rows get equal results.
    - Without labelled urls of both verdicts there is nothing to learn: the method
      gives the only verdict seen, or allow.
    - An empty table gives an empty result.

    ``fit_rows`` bounds the labelled sample for the trees (drawn by a hash of the
    id, each verdict apart); suffix statistics count all labelled urls but the judged one.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")) \
        .withColumns({"host": host, "path": path}).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else F.lit(None).cast("map<string,string>")
    rows = rows.withColumn("block", F.when(F.col("rule").isNotNull(), (verdicts[F.col("rule")] == "block").cast("double")))
    rows = materialise(lexical(rows).drop("url"), "features")
    seen = rows.where("block IS NOT NULL").agg(F.count("*"), F.coalesce(F.avg("block"), F.lit(0.0))).first()
    n, base = seen
    if not 0 < base < 1:
        return rows.select("page_id", "host", "path", "rule", F.when(F.coalesce("block", F.lit(float(base))) >= 0.5, "block").otherwise("allow").alias("verdict"),
                           F.when(F.col("rule").isNull(), F.lit(float(base))).alias("p_block"))
    # A labelled url's suffix statistics leave its own label out, else the trees would read it there.
    own = F.coalesce("block", F.lit(0.0))
    for k in (1, 2):
        stats = rows.where("block IS NOT NULL").groupBy(f"suffix{k}").agg(F.sum("block").alias("_blocked"), F.count("*").alias("_seen"))
        others = F.coalesce("_seen", F.lit(0)) - F.col("block").isNotNull().cast("int")
        rows = rows.join(small_side(materialise(stats, "suffixes"), 100_000), f"suffix{k}", "left") \
            .withColumns({f"suffix{k}_rate": (F.coalesce("_blocked", F.lit(0.0)) - own + 5 * base) / (others + 5), f"suffix{k}_seen": F.log1p(others)}) \
            .drop("_blocked", "_seen")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)
    # Both verdicts are drawn apart, up to half the bound each, and weighted back to their shares.
    share = {1.0: min(1.0, fit_rows / 2 / (n * base)), 0.0: min(1.0, fit_rows / 2 / (n * (1 - base)))}
    rate = F.when(F.col("block") == 1, share[1.0]).otherwise(share[0.0])
    sample = rows.where("block IS NOT NULL").where(uniform(seed, F.col("page_id")) < rate).select("vector", "block", (1 / rate).alias("weight"))
    # A bounded sample in a fixed number of parts and a fixed order: the same trees each time.
    sample = materialise(sample.repartition(8, F.xxhash64("vector")).sortWithinPartitions(F.xxhash64("vector")), "sample")
    model = GBTClassifier(featuresCol="vector", labelCol="block", weightCol="weight", maxIter=12, maxDepth=4, stepSize=0.3, seed=seed).fit(sample)
    judged = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    return judged.select("page_id", "host", "path", "rule",
                         F.when(F.coalesce("block", F.col("p")) >= 0.5, "block").otherwise("allow").alias("verdict"),
                         F.when(F.col("rule").isNull(), F.col("p")).alias("p_block"))
