"""URL filters: listed host and path rules, and association rules mined from the verdicts of the listed pages.

Pages that a listed rule fits are labelled by it. FP-growth mines their URL tokens together with the verdict; frequent
token sets that imply a verdict with enough confidence become rules. Each mined rule is indexed under its rarest token, so
a page only meets rules whose rarest token it has, and a rule fits if the page has all its tokens. DataFrame operations
only.
"""
from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Listed rules: verdict, then host and path prefix. The longest that fits wins.
LISTED = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Share of the labelled pages that a mined token set needs, and share of those with its verdict. Sets may have any size.
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
#: The verdict where neither a listed nor a mined rule fits.
OTHERWISE = "allow"
_VERDICT = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for a null url or one without `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """The longest rule (`verdict`, `rule`) that fits, else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct host labels, path segments, endings of the last segment, and query parameters."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    parts = [
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path:"), x)),
        F.array(F.concat(F.lit("path:."), F.regexp_extract(path, r"\.([^./]*)$", 1))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), x)),
    ]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: ~x.rlike(r"^(host|path|query):\.?$")))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """`antecedent, verdict, support, confidence, rarest` from `tokens, verdict`; rules that never win are left out."""
    rows = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_VERDICT), "verdict"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(rows).freqItemsets
    found = found.select(
        F.array_sort(F.filter("items", lambda x: ~x.startswith(_VERDICT))).alias("antecedent"),
        F.get(F.filter("items", lambda x: x.startswith(_VERDICT)), F.lit(0)).alias("label"), "freq",
    ).filter(F.size("antecedent") > 0)
    base = found.filter("label is null").select("antecedent", F.col("freq").alias("total"))
    rules = found.filter("label is not null").join(base, "antecedent").select(
        "antecedent", F.substring("label", len(_VERDICT) + 1, 100).alias("verdict"), F.col("freq").alias("support"), (F.col("freq") / F.col("total")).alias("confidence"),
    ).filter(F.col("confidence") >= min_confidence)
    # a rule never wins against one with a token less and no less confidence: that one fits too, with no less support
    part = F.explode(F.transform("antecedent", lambda x: F.array_remove("antecedent", x)))
    smaller = rules.filter(F.size("antecedent") > 1).select("antecedent", "verdict", "confidence", part.alias("part"))
    other = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("other"))
    beaten = smaller.join(other, "part").filter("other >= confidence").select("antecedent", "verdict").distinct()
    rules = rules.join(beaten, ["antecedent", "verdict"], "left_anti")
    single = base.filter(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("token"), "total")
    each = rules.select("antecedent", F.explode("antecedent").alias("token")).distinct().join(single, "token")
    rarest = each.groupBy("antecedent").agg(F.min(F.struct("total", "token")).getField("token").alias("rarest"))
    return rules.join(rarest, "antecedent")


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`url, mined`: the mined rule that fits best, for the urls (`url, tokens`, distinct) that any fits.

    Best: highest confidence, then support, then fewest tokens, then the first in order of tokens and verdict.
    """
    met = urls.withColumn("rarest", F.explode("tokens")).join(rules, "rarest")
    fits = met.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    rank = F.struct(-F.col("confidence"), -F.col("support"), F.size("antecedent"), F.concat_ws(" ", "antecedent").alias("rule"), F.col("verdict"))
    return fits.groupBy("url").agg(F.min(rank).alias("best")).select("url", F.struct("best.verdict", "best.rule").alias("mined"))


def judge(pages: DataFrame, rules=LISTED) -> DataFrame:
    """`page_id, host, path, rule, verdict, mined_rule` for every row of `pages`.

    `rule` is the listed rule that fits, else null; the verdict is that rule's, else the best mined rule's, else `allow`.
    Null urls and urls without `://` have an empty host and path and get `allow`. Repeated rows come back as they are.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    cut = tokens(F.col("host"), F.col("path"), F.col("url"))
    labelled = parsed.filter("listed is not null").select(cut.alias("tokens"), "listed.verdict")
    open_ = parsed.filter("listed is null and host <> ''").select("url", cut.alias("tokens")).dropDuplicates(["url"])
    mined = best_rules(open_, mine(labelled))
    return parsed.join(mined, "url", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"), F.coalesce("listed.verdict", "mined.verdict", F.lit(OTHERWISE)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("mined.rule")).alias("mined_rule"),
    )
