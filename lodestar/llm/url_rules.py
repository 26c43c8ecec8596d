"""URL filters (operator 8): fixed host rules first, then mined association rules.

FP-growth mines token combinations that go with a verdict among labelled urls; rules below the least
support or confidence are dropped.  The rest form an inverted index under each
rule's rarest token: a url's token set meets only the rules listed under its own tokens, and a rule
fits when the set holds all its tokens.  DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut

#: The rules of the contract (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEFAULT = "allow"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
_VERDICT = "verdict="


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.when(F.instr(url, "://") > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or above it and whose
    path begins the url's; null when none fits (ties: the rule listed first)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens, sorted: host labels, path segments (digits as ``#``), query keys and
    whether there is a fragment.  A null url has none."""
    tagged = lambda tag, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"(?s)^[^=]*", 0))
    segments = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, r"[0-9]+", "#"))
    all_ = F.concat(tagged("host=", F.split(host, r"\.")), tagged("path=", segments), tagged("query=", keys),
                    F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    return F.coalesce(F.sort_array(F.array_distinct(all_)), F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(items, verdict) rows -> rules (items, verdict, support, confidence, rare).

    ``items`` is a token array, ``verdict`` allow or block (others and null are skipped).  ``rare`` is the rule's least
    frequent token, under which the index lists it.
    """
    sets = cut(labelled.where(F.col("verdict").isin("allow", "block") & (F.size("items") > 0)).select(
        F.concat("items", F.array(F.concat(F.lit(_VERDICT), "verdict"))).alias("items")))
    n = sets.count()
    if not n:
        return sets.select("items", F.lit("").alias("verdict"), F.lit(0.0).alias("support"), F.lit(0.0).alias("confidence"), F.lit("").alias("rare"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(sets)
    freq = cut(model.freqItemsets.select(F.sort_array("items").alias("items"), "freq"))
    is_verdict = lambda x: x.startswith(_VERDICT)
    with_verdict = freq.where(F.exists("items", is_verdict)).select(
        F.filter("items", lambda x: ~is_verdict(x)).alias("items"), F.filter("items", is_verdict)[0].alias("v"), F.col("freq").alias("both"))
    rules = with_verdict.where(F.size("items") > 0).join(freq, "items").select(
        "items", F.substring("v", len(_VERDICT) + 1, 99).alias("verdict"), (F.col("both") / n).alias("support"),
        (F.col("both") / F.col("freq")).alias("confidence")).where(F.col("confidence") >= min_confidence)
    single = freq.where(F.size("items") == 1).select(F.col("items")[0].alias("rare"), F.col("freq").alias("f"))
    rare = rules.select("items", "verdict", F.explode("items").alias("rare")).join(single, "rare").groupBy("items", "verdict").agg(
        F.min_by("rare", F.struct("f", "rare")).alias("rare"))
    return cut(rules.join(rare, ["items", "verdict"]))


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(items) -> (items, mined): the verdict of the best rule that fits a token set, by
    confidence, then support, then more tokens, then block before allow, then the tokens."""
    rules = rules.select("rare", F.col("items").alias("need"), "verdict", "support", "confidence")
    best = F.struct("confidence", "support", F.size("need"), "verdict", F.array_join("need", " "))
    return (sets.select("items", F.explode("items").alias("rare")).join(rules, "rare")
            .where(F.size(F.array_except("need", "items")) == 0).groupBy("items").agg(F.max_by("verdict", best).alias("mined")))


def judge(pages: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id",
          rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, method).

    A fixed rule decides where one fits; else the best mined rule, else ``DEFAULT``.
    The labelled urls that rules are mined from are all pages with a fixed rule (its
    verdict) and all other pages that ``labels`` knows by id (block if any label says
    quality 0 or toxic 1).  ``method`` says what decided: rule, mined or default.  A url
    that is null or has no ``://`` has empty host and path and fits no fixed rule.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("fixed"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("items"))
    known = rows.select("page_id", "items", "fixed")
    if labels is not None:
        bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
        said = labels.select(F.col(label_id).alias("page_id"), F.when(bad, 1).otherwise(0).alias("bad")).where("page_id is not null")
        said = said.groupBy("page_id").agg(F.when(F.max("bad") == 1, "block").otherwise("allow").alias("said"))
        known = known.join(said, "page_id", "left").withColumn("fixed", F.coalesce("fixed", "said"))
    mined = mine(known.select("items", F.col("fixed").alias("verdict")), min_support, min_confidence)
    sets = rows.where("fixed is null").select("items").distinct()
    found = cut(match(sets, mined))
    return rows.join(found, "items", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit(DEFAULT)).alias("verdict"),
        F.when(F.col("fixed").isNotNull(), "rule").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("method"))
