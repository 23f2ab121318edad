"""Operator 8, URL filters: fixed host rules, then association rules mined from labelled URLs.

Spark's FP-growth mines combinations of URL tokens from the labelled pages;
rules `tokens => block` of enough support and confidence are kept.  A URL that
no fixed rule fits is blocked where a mined rule's tokens are all among its
own.  Matching is an inverted index: each rule is filed under its rarest
token, and only distinct token sets look rules up, so a host that holds a
third of all pages is matched once.

Defined cases: a null url or one without "://" has empty host and path, no
tokens and is allowed; pages with the same id get a row each, and a page with
several label rows is several observations; a label is bad if quality is 0 or
toxic is 1 (nulls are neither); with no labelled page nothing is mined and the
method allows all; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path prefix, verdict), fixed rules; a rule is written host + path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A rule needs this many bad labelled pages that hold all its tokens, however many pages there are.
MIN_PAGES = 10
MIN_CONFIDENCE = 0.6
#: Keys over which the pages of one token set are dealt for the last join.
SALTS = 64
_BLOCK = "label=block"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as host + path, else null."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: len(r[0] + r[1])):
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(h + p)).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path parts, names in the query, whether there is a fragment; digits as one 0."""
    tidy = F.regexp_replace(ascii_lower(F.coalesce(url, F.lit(""))), "[0-9]+", "0")
    tagged = lambda tag, text, at: F.transform(F.filter(F.split(text, at), lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    host = F.regexp_extract(tidy, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(tidy, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)
    query = F.regexp_extract(tidy, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.when(~tidy.contains("://"), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(
        tagged("host:", host, "\\."), tagged("path:", path, "[/.]"),
        F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("query:"), x)),
        F.when(F.regexp_extract(tidy, r"(?s)^.*?://[^#]*#(.+)$", 1) != "", F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))))


def mine(pages: DataFrame, labels: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, anchor): antecedents of rules that end in block, with the rarest token of each."""
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("quality") == 0, F.col("toxic") == 1, F.lit(False))
    seen = pages.join(labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), "page_id").select(
        F.when(F.col("bad"), F.array_append("tokens", F.lit(_BLOCK))).otherwise(F.col("tokens")).alias("items"))
    # FP-growth takes a share and rounds the count up: half a page less is on the safe side of rounding
    share = min(1.0, (min_pages - 0.5) / max(seen.count(), 1))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(seen)
    rules = model.associationRules.where(F.col("consequent")[0] == _BLOCK).select(F.sort_array("antecedent").alias("rule"))
    singles = model.freqItemsets.where("size(items) = 1").select(F.col("items")[0].alias("token"), "freq")
    filed = rules.select("rule", F.explode("rule").alias("token")).join(singles, "token")
    return filed.groupBy("rule").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict for every page row."""
    url = F.col("url")
    known = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    mined = mine(known.select("page_id", "tokens"), labels, **mining)
    sets = known.select("tokens").distinct()
    hit = (
        sets.select("tokens", F.explode("tokens").alias("anchor")).join(mined, "anchor")
        .where(F.size(F.array_except("rule", "tokens")) == 0).select("tokens").distinct().withColumn("mined", F.lit("block"))
    )
    # pages of one token set may be a third of all: they are dealt over SALTS keys
    known = known.withColumn("salt", F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(SALTS)).cast("int"))
    hit = hit.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rule = fixed_rule(F.col("host"), F.col("path"), rules)
    verdicts = F.create_map(*[F.lit(x) for h, p, v in rules for x in (h + p, v)])
    return known.join(hit, ["tokens", "salt"], "left").withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", F.coalesce(F.try_element_at(verdicts, F.col("rule")), "mined", F.lit("allow")).alias("verdict"))
