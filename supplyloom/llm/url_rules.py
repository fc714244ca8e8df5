"""URL filtering by given host rules and by association rules mined with FP-growth, in DataFrame operations only.

Given rules decide first, the longest one that fits. For all other URLs, rules are mined: a transaction is the set of
tokens of a labelled URL (host labels, path words, query names) and its label. Rules token set => block with enough
support and confidence are kept unless a smaller set already does as well; they are put into an inverted
index under their rarest token, and a URL is blocked if all tokens of an indexed rule are among its own.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.common import lower_ascii, staged

# (verdict, host, path): fixed values of the contract
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT, CONFIDENCE = 0.002, 0.8
LEAST = 20  # labelled URLs that a rule must rest on at least
BLOCK, ALLOW = "=block", "=allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for NULL and for texts without ``://``."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule that fits, NULL where none does."""
    name = verdict = F.lit(None).cast("string")
    for what, own, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        name, verdict = F.when(fits, own + prefix).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, path words and names of the query, each marked with its kind; no numbers."""
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")

    def marked(kind: str, words: Column) -> Column:
        named = F.filter(words, lambda w: w.rlike(r"\D"))
        return F.transform(named, lambda w: F.concat(F.lit(kind), w))

    return F.array_distinct(
        F.concat(
            marked("h:", F.split(host, r"\.")),
            marked("p:", F.split(path, "[/._-]")),
            marked("q:", F.transform(query, lambda w: F.regexp_extract(w, "^([^=]*)", 1))),
        )
    )


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``tokens, confidence`` of the kept rules, from ``labelled (tokens, label)`` with labels BLOCK and ALLOW.

    A rule goes if a proper subset of its tokens has at least its confidence: it could not block anything more.
    The number of frequent sets is bounded by the support and the tokens of one URL, not by the rows.
    """
    items = labelled.select(F.array_append("tokens", F.col("label")).alias("items"))
    share = min(1.0, max(support, LEAST / max(1, items.count())))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(items)
    rules = staged(
        model.associationRules.filter((F.col("consequent")[0] == BLOCK) & ~F.array_contains("antecedent", ALLOW)).select(
            F.array_sort("antecedent").alias("tokens"), "confidence"
        )
    )
    small = rules.select(F.col("tokens").alias("t"), F.col("confidence").alias("c"), F.explode("tokens").alias("token"))
    big = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    implied = (
        big.join(small, "token")
        .filter((F.size("t") < F.size("tokens")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("t", "tokens")) == 0))
        .select("tokens")
        .distinct()
    )
    return rules.join(implied, "tokens", "left_anti")


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, confidence`` of the distinct URLs (``url, tokens``) that some rule fits, with the best confidence.

    The index has one entry for each rule, under the token that fewest rules share; a URL meets a rule only there.
    """
    uses = rules.select(F.explode("tokens").alias("token")).groupBy("token").count()
    index = (
        rules.select(F.col("tokens").alias("needed"), "confidence", F.explode("tokens").alias("token"))
        .join(uses, "token")
        .groupBy("needed", "confidence")
        .agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    )
    return (
        urls.withColumn("token", F.explode("tokens"))
        .join(index, "token")
        .filter(F.size(F.array_except("needed", "tokens")) == 0)
        .groupBy("url")
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` for every row.

    The label of a URL is the verdict of a given rule that fits it, else what ``labels`` says of the id of the page:
    block for toxic or low quality, allow otherwise. Pages with neither do not train. ``confidence`` is that of the
    mined rule that blocks, else NULL. URLs that are NULL or have no ``://`` have no tokens and are allowed. Of
    repeated labels of an id any that blocks counts.
    """
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = given_rule(F.col("host"), F.col("path"))
    rows = rows.withColumn("rule", name).withColumn("given", verdict)
    tokens = url_tokens(F.coalesce("url", F.lit("")), F.col("host"), F.col("path")).alias("tokens")
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    labelled = (
        rows.filter("host != ''")
        .join(known, "page_id", "left")
        .withColumn("label", F.coalesce(F.concat(F.lit("="), "given"), F.when(F.col("bad"), BLOCK).when(~F.col("bad"), ALLOW)))
        .filter("label is not null")
        .select(tokens, "label")
    )
    rules = staged(mine(staged(labelled)))
    open_urls = rows.filter("given is null and host != ''").select("url", tokens).dropDuplicates(["url"])
    blocked = matching(open_urls, rules).withColumnRenamed("url", "u")
    return (
        rows.join(blocked, (F.col("url") == F.col("u")) & F.col("given").isNull(), "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("given", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
            "confidence",
        )
    )
