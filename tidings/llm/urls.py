"""URL filters: rules first, then a character language-model ratio.

Urls that a rule accepts or rejects train two smoothed variable-order Markov
models of characters (contexts of up to ``ORDER`` characters, Witten-Bell
interpolation down to the uniform distribution). A url is judged by the mean over
its characters of the log-likelihood difference, against a threshold
calibrated by cross-fitting: the labelled urls fall into two halves by hash, each
half is scored by models of the other, and the threshold lies between the means of
both classes, nearer to the one that varies less. The scores of the result come from models of
all labelled urls.

Counts are of distinct urls and cover all of them. Everything is DataFrame functions:
characters with their context are counted once at full length, lower orders
are sums of those counts, and each distinct context and character gets one
log ratio for each of the three pairs of models, which the urls join under a number of their own.

Defined cases: a null url or one without ``://`` has empty host and path; its
whole text (null: empty) is judged. Where only one class has urls, the method
gives that class, without any ``allow``. Where a class has urls in one half only, its model
of the other half is the uniform distribution. Rows of equal url get equal results; null ids
are carried along; other columns are ignored. An empty table gives no rows. Of rules of equal length
that fit, the one listed first wins; a score at the threshold is allowed. A very long url is judged whole; its
characters become narrow rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import cut

# The rules (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
KINDS = ("allow", "block")
ORDER = 4               # characters of the longest context
SYMBOLS = 256.0         # the uniform distribution under all orders
BEGIN, END = "\x02", "\x03"


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))


def host_and_path(pages: DataFrame) -> DataFrame:
    rest = F.coalesce(rest_of(F.col("url")), F.lit(""))
    return (pages.withColumn("host", F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                                                 string.ascii_uppercase, string.ascii_lowercase))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, else null."""
    rule = verdict = None
    for kind, own, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, own + start) if rule is None else rule.when(fits, own + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def grams(urls: DataFrame) -> DataFrame:
    """``urls`` with a row for each character: gram, it and the ORDER characters before."""
    rest = F.translate(F.coalesce(rest_of(F.col("url")), F.col("url"), F.lit("")),
                       string.ascii_uppercase, string.ascii_lowercase)
    whole = F.concat(F.lit(BEGIN * ORDER), rest, F.lit(END))
    return (urls.withColumn("whole", whole).withColumn("gram", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("whole") - ORDER),
        lambda i: F.substring("whole", i, F.lit(ORDER + 1))))).drop("whole"))


def log_ratios(counts: DataFrame, models=("",)) -> DataFrame:
    """(gram, ratio) from (gram, n_allow, n_block): log p_allow - log p_block.

    Each name of ``models`` ends the columns of one pair of models and of its ratio."""
    sides = [kind + m for m in models for kind in KINDS]
    probs = {c: F.lit(1 / SYMBOLS) for c in sides}
    rows = counts
    for k in range(ORDER + 1):
        tail = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = (counts.groupBy(tail.alias("tail"))
                .agg(*[F.sum(f"n_{c}").alias(f"c_{c}") for c in sides]))
        ctx = F.substring("tail", 1, k) if k else F.lit("")
        totals = seen.groupBy(ctx.alias("ctx")).agg(
            *[F.sum(f"c_{c}").alias(f"t_{c}") for c in sides],
            *[F.sum((F.col(f"c_{c}") > 0).cast("long")).alias(f"d_{c}") for c in sides])
        if k:
            table = seen.join(totals, F.substring("tail", 1, k) == F.col("ctx")).drop("ctx")
        else:
            one = totals.drop("ctx").first()
            table = seen.select("*", *[F.lit(one[x] if one else 0).alias(x) for x in totals.columns if x != "ctx"])
        rows = rows.join(table, F.substring("gram", ORDER + 1 - k, k + 1) == F.col("tail"))
        new = {c: F.when(F.col(f"t_{c}") > 0, (F.col(f"c_{c}") + F.col(f"d_{c}") * p)
                         / (F.col(f"t_{c}") + F.col(f"d_{c}"))).otherwise(p) for c, p in probs.items()}
        rows = rows.select("gram", *[f"n_{c}" for c in sides], *[new[c].alias(f"p_{c}") for c in probs])
        probs = {c: F.col(f"p_{c}") for c in probs}
    return rows.select("gram", *[(F.log(f"p_allow{m}") - F.log(f"p_block{m}")).alias(f"ratio{m}") for m in models])


def threshold_of(scored: DataFrame) -> Column:
    """The calibrated threshold, from (known, crossed): scores by models of the other half.

    Both classes have urls."""
    one = scored.where(F.col("known").isNotNull()).groupBy("known").agg(
        F.avg("crossed").alias("m"), F.coalesce(F.stddev_pop("crossed"), F.lit(0.0)).alias("s")).collect()
    at = {r["known"]: (r["m"], r["s"]) for r in one}
    (ma, sa), (mb, sb) = at["allow"], at["block"]
    sa, sb = sa + 1e-9, sb + 1e-9
    return F.lit(float((ma * sb + mb * sa) / (sa + sb)))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, score."""
    own = pages.select("page_id", "url")
    rule, known = rule_columns(F.col("host"), F.col("path"), rules)
    # numbered once and written, so that no url travels with its characters
    urls = cut(host_and_path(own.select("url").distinct())
               .select(F.monotonically_increasing_id().alias("key"), "url", known.alias("known"),
                       F.pmod(F.xxhash64("url"), F.lit(2)).alias("half")))
    halves = cut(grams(urls).groupBy("gram").agg(
        *[F.coalesce(F.sum(((F.col("known") == c) & (F.col("half") == h)).cast("long")), F.lit(0)).alias(f"n_{c}_{h}")
          for c in KINDS for h in (0, 1)]))
    counts = halves.select("*", *[(F.col(f"n_{c}_0") + F.col(f"n_{c}_1")).alias(f"n_{c}") for c in KINDS])
    ratios = cut(log_ratios(counts, ("", "_0", "_1")))
    scored = cut(grams(urls).select("key", "known", "half", "gram").join(ratios, "gram")
                 .groupBy("key", "known", "half")
                 .agg(*[F.avg(r).alias(r) for r in ("ratio", "ratio_0", "ratio_1")])
                 .select("key", "known", F.col("ratio").alias("score"),
                         F.when(F.col("half") == 0, F.col("ratio_1")).otherwise(F.col("ratio_0")).alias("crossed")))
    kinds = {r["known"] for r in urls.groupBy("known").count().collect()} - {None}
    if len(kinds) == 2:
        judged = F.when(F.col("score") >= threshold_of(scored), "allow").otherwise("block")
    else:
        judged = F.lit(next(iter(kinds), "allow"))
    seen = urls.select("key", F.col("url").alias("of")).join(scored.select("key", "score"), "key").drop("key")
    return (host_and_path(own).join(seen, F.col("url").eqNullSafe(F.col("of")), "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(known, judged).alias("verdict"), "score"))
