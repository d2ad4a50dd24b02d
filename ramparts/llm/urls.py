"""URL verdicts: a list of host and path rules first, then association rules mined from labels; SQL functions and
Spark's FP-growth only."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The rule list, by host and path.
LISTED = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

LABEL = "label="
# A mined rule needs this share of the labelled pages and this share of those it fits.
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.005, 0.8
# ... and this number of labelled pages, so that a few pages make no rule.
LEAST_PAGES = 20
OTHERWISE = "allow"


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) host of a url; empty for a null or a url without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Tokens with their place in the url, one of each kind at most; ``parts_of`` has the others."""
    labels, folders = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda f: f != "")
    query = F.regexp_extract(url, r"(?s)\?([^=&#]*)", 1)
    named = {
        "scheme": F.regexp_extract(url, r"(?s)^(.*?)://", 1),
        "top": F.try_element_at(labels, F.lit(-1)),
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2)),
        "sub": F.when(F.size(labels) > 2, labels[0]),
        "folder1": F.when(F.size(folders) > 1, F.get(folders, F.lit(0))),
        "folder2": F.when(F.size(folders) > 2, F.get(folders, F.lit(1))),
        "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
        "query": query,
        "mark": F.when(F.contains(url, F.lit("#")), F.lit("fragment")),
    }
    items = [F.when(value != "", F.concat(F.lit(f"{kind}="), value)) for kind, value in named.items()]
    return F.array_compact(F.array(*items))


def parts_of(url: Column, host: Column, path: Column) -> Column:
    """Tokens for every host label, every domain of three labels or more that the host is under, every path segment
    and every query name, each once."""
    labels, segments = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda f: f != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "[&;]"), lambda q: F.regexp_extract(q, "(?s)^([^=]*)", 1))
    depths = F.filter(F.sequence(F.lit(1), F.size(labels)), lambda d: d > 2)
    above = F.transform(depths, lambda d: F.concat_ws(".", F.slice(labels, F.size(labels) - d + 1, d)))
    kinds = {"anylabel": labels, "anyabove": above, "anyfolder": segments, "anyname": names}

    def marked(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(f"{kind}="), v))

    return F.array_distinct(F.concat(*[marked(kind, values) for kind, values in kinds.items()]))


def with_tokens(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url, host, path, tokens, parts) of the distinct urls."""
    urls = pages.select(F.col(f"`{url}`").alias("url")).distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    of = (F.coalesce("url", F.lit("")), F.col("host"), F.col("path"))
    return parts.withColumn("tokens", tokens_of(*of)).withColumn("parts", parts_of(*of))


def mined_tokens(urls: DataFrame, labelled: DataFrame, support: float = LEAST_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """``urls`` (url, tokens, parts) and ``labelled`` (url, verdict) as (url, tokens) and (tokens, verdict), the tokens
    being classes of tokens that reach ``support`` among the labelled pages.

    A token below it is in no frequent set. Tokens that stand on the same labelled pages follow from one another there
    and are one item, named by all of them: as items apart they would double the frequent sets each, with rules that
    say the same. A url has the class if it has one of its tokens.
    """
    n = labelled.count()
    least = max(support * n, LEAST_PAGES) - 1e-6
    all_tokens = urls.select("url", F.explode(F.array_union("tokens", "parts")).alias("token"))
    # A page counts as often as it is labelled; sums over pages tell whether two tokens have the same ones.
    weights = labelled.groupBy("url").agg(F.count(F.lit(1)).alias("w"))
    marks = [F.xxhash64("url", F.lit(i)).cast("decimal(38,0)") for i in (1, 2)]
    frequent = (
        all_tokens.join(weights, "url")
        .groupBy("token")
        .agg(F.sum("w").alias("n"), F.sum(marks[0]).alias("m1"), F.sum(marks[1]).alias("m2"))
        .filter(F.col("n") >= least)
    )
    classes = frequent.groupBy("n", "m1", "m2").agg(F.sort_array(F.collect_list("token"), asc=False).alias("all"))
    named = classes.select(F.array_join("all", "|").alias("class"), F.explode("all").alias("token"))
    held = all_tokens.join(named, "token").groupBy("url").agg(F.collect_set("class").alias("tokens"))
    baskets = labelled.join(held, "url", "left")
    empty = F.array().cast("array<string>")
    return held, baskets.select(F.coalesce("tokens", empty).alias("tokens"), "verdict")


def mined_rules(
    labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE
) -> DataFrame:
    """(rule, tokens, verdict, confidence, support) from (tokens, verdict), mined over all labelled pages.

    FP-growth lists token sets with ``support``; of each, the verdict that follows with ``confidence`` makes a rule.
    A rule is pruned when part of its tokens gives the same verdict with at least its confidence. The frequent
    sets of a page grow with its items, which ``mined_tokens`` keeps to distinct ones that reach the support.
    """
    n = labelled.count()
    if n < LEAST_PAGES:
        schema = "rule string, verdict string, tokens array<string>, confidence double, support double"
        return labelled.sparkSession.createDataFrame([], schema)
    support = max(support, LEAST_PAGES / n)
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = model.associationRules.filter(F.startswith(F.element_at("consequent", 1), F.lit(LABEL))).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substr(F.element_at("consequent", 1), F.lit(len(LABEL) + 1)).alias("verdict"),
        "confidence",
        "support",
    )
    found = found.withColumn("rule", F.array_join("tokens", " "))
    # A rule's shorter forms are looked up by one of their tokens, as pages are.
    shorter = found.select(
        F.explode("tokens").alias("token"),
        F.col("tokens").alias("part"),
        F.col("verdict").alias("part_verdict"),
        F.col("confidence").alias("part_confidence"),
    )
    covered = (
        found.select("rule", "tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
        .join(shorter, "token")
        .filter(
            (F.col("verdict") == F.col("part_verdict"))
            & (F.size("part") < F.size("tokens"))
            & (F.col("part_confidence") >= F.col("confidence"))
            & (F.size(F.array_except("part", "tokens")) == 0)
        )
        .select("rule", "verdict")
        .distinct()
    )
    return found.join(covered, ["rule", "verdict"], "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined, mined_rule): the verdict of the best rule that fits each url, for urls that one fits.

    The index lists each rule under its rarest token (fewest urls); a url looks its tokens up there and keeps rules
    whose tokens it has all. The most confident rule wins, then the better supported, the longer, the first by name.
    """
    listed = rules.select("rule", "tokens", "verdict", "confidence", "support", F.explode("tokens").alias("token"))
    seen = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    common = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = (
        listed.join(common, "token")
        .groupBy("rule", "verdict")
        .agg(F.min(F.struct("n", "token"))["token"].alias("token"), F.first("tokens").alias("needed"),
             F.first("confidence").alias("confidence"), F.first("support").alias("support"))
    )
    hits = seen.join(index, "token").filter(F.size(F.array_except("needed", "tokens")) == 0)
    order = F.struct("confidence", "support", F.size("needed"), "rule", "verdict")
    return hits.groupBy("url").agg(F.max(order).alias("best")).select(
        "url", F.col("best.verdict").alias("mined"), F.col("best.rule").alias("mined_rule")
    )


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]] = LISTED) -> Column:
    """(rule, verdict) of the longest listed rule whose host is that of the url or above it and whose path begins the
    url's; of equal lengths the first in the list; null if none fits."""
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        rule_host, slash, rule_path = rule.partition("/")
        under = (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits.append(F.when(under & F.startswith(path, F.lit(slash + rule_path)), value))
    return F.coalesce(*fits)


def verdicts(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule: a row for each row of ``pages``.

    ``labels`` (doc_id, quality, toxic) names pages by their key; a page of quality 0 or toxic is one to block. Null
    labels say nothing. Urls are judged once each. Null urls have empty parts and the verdict where no rule fits.
    """
    urls = with_tokens(pages, url)
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.select(F.col("doc_id").alias("k"), F.when(bad, "block").otherwise("allow").alias("verdict"), bad.alias("b"))
    labelled = (
        pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{url}`").alias("url"))
        .join(known.filter(F.col("b").isNotNull()), "k")
        .filter(F.col("url").isNotNull())
        .select("url", "verdict")
    )
    held, baskets = mined_tokens(urls, labelled)
    mined = matched(held, mined_rules(baskets))
    best = listed_rule(F.col("host"), F.col("path"))
    judged = urls.join(mined, "url", "left").select("url", "host", "path", best.alias("best"), "mined", "mined_rule")
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    return rows.join(judged, rows["url"].eqNullSafe(judged["url"]), "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "mined", F.lit(OTHERWISE)).alias("verdict"),
        "mined_rule",
    )
