"""URL filtering by rules and, where none fits, by the ratio of two character models.

URLs that rules accept and reject train one Markov model each, of variable order with Witten-Bell
smoothing: a context that was never seen leaves the estimate to the next shorter one. A URL is
judged by the difference of its log-likelihoods per character against a threshold that is
calibrated on labelled URLs held out of training.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, skewed_join, written

#: (verdict, host, path): fits the host and its subdomains where the path begins with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Characters of context at most, and of different characters taken for the shortest estimate.
ORDER = 4
ALPHABET = 256
#: One of so many labelled URLs is held out for the threshold.
HELD_OUT = 5
#: Scores are kept in millionths (sums of whole numbers don't depend on order), and the threshold
#: lies between steps of 1 hundredth from -MOST to MOST.
UNIT, STEP, MOST = 1_000_000, 10_000, 2_000

_BEGIN, _END = "\x02", "\x03"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; ``rules`` are a few."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(text: Column, order: int) -> Column:
    """Each character of the text and its end, with the ``order`` characters before it."""
    padded = F.concat(F.lit(_BEGIN * order), text, F.lit(_END))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))


def _estimates(counts: DataFrame, order: int) -> DataFrame:
    """(gram, score): the log ratio of the two models' estimates in millionths.

    ``counts`` has (gram, a, r) for every gram to be scored or counted. Estimates of order k come
    from those of order k - 1 for the same characters without the first; a context has as many
    grams as there are characters at most.
    """
    levels = [counts]
    for _ in range(order):
        shorter = levels[-1].groupBy(F.expr("substring(gram, 2)").alias("gram"))
        levels.append(written(shorter.agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "url-level"))
    levels.reverse()
    sums = [F.sum(F.col(c)) for c in "ar"] + [F.sum((F.col(c) > 0).cast("long")) for c in "ar"]
    known = [float(x or 0) for x in levels[0].agg(*sums).first()]

    def estimate(count: Column, n: Column, kinds: Column, before: Column) -> Column:
        return F.when(n > 0, (count + kinds * before) / (n + kinds)).otherwise(before)

    flat = F.lit(1.0 / ALPHABET)
    below = levels[0].select(
        "gram",
        estimate(F.col("a"), F.lit(known[0]), F.lit(known[2]), flat).alias("pa"),
        estimate(F.col("r"), F.lit(known[1]), F.lit(known[3]), flat).alias("pr"),
    )
    for k in range(1, order + 1):
        same = Window.partitionBy(F.expr(f"substring(gram, 1, {k})"))
        own = levels[k].select(
            "gram", "a", "r", F.expr("substring(gram, 2)").alias("shorter"),
            F.sum("a").over(same).alias("na"), F.sum("r").over(same).alias("nr"),
            F.sum((F.col("a") > 0).cast("long")).over(same).alias("ka"),
            F.sum((F.col("r") > 0).cast("long")).over(same).alias("kr"),
        )
        below = written(
            own.join(below.select(F.col("gram").alias("shorter"), "pa", "pr"), "shorter").select(
                "gram",
                estimate(F.col("a"), F.col("na"), F.col("ka"), F.col("pa")).alias("pa"),
                estimate(F.col("r"), F.col("nr"), F.col("kr"), F.col("pr")).alias("pr"),
            ),
            "url-estimates",
        )
    return below.select("gram", F.round((F.ln("pa") - F.ln("pr")) * UNIT).cast("long").alias("score"))


def _threshold(scored: DataFrame) -> int:
    """The score that tells held-out accepted URLs best from rejected ones (balanced accuracy).

    Comes from a histogram of a bounded number of steps; of equally good ones in a row the
    middle one.
    """
    step = F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(F.col("score") / STEP)))
    rows = scored.groupBy(step.alias("step")).agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("a"), F.sum((F.col("verdict") == "block").cast("long")).alias("r")
    )
    bars = {r["step"]: (r["a"], r["r"]) for r in rows.collect()}
    accepted, rejected = sum(a for a, _ in bars.values()), sum(r for _, r in bars.values())
    if not accepted or not rejected:
        return -(1 << 62)
    best, first, last, lost, caught = 1.0, None, None, 0, 0
    for step in range(-MOST, MOST + 1):
        a, r = bars.get(step, (0, 0))
        lost, caught = lost + a, caught + r
        good = (accepted - lost) / accepted + caught / rejected
        if good > best:
            best, first, last = good, step, step
        elif good == best and last == step - 1:
            last = step
    return -(1 << 62) if first is None else (first + last + 2) // 2 * STEP


def judge_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    order: int = ORDER,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (of the method; null under a rule).

    The longest rule that fits decides; other URLs are allowed if their log-likelihood ratio per
    character, in natural units, reaches the calibrated threshold. A null URL or one without
    ``://`` has an empty host and path, which the models judge too. Rows that repeat are judged
    alike; where the rules leave no URL of one verdict to learn from, the others are allowed; an
    empty table gives no rows.
    """
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path")
    ).withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    held = F.pmod(F.xxhash64("host", "path"), F.lit(HELD_OUT)) == 0
    rows = written(
        rows.select(
            "row", "page_id", "host", "path", "found.rule", "found.verdict",
            (F.col("found.rule").isNotNull() & ~held).alias("train"),
        ),
        "url-rows",
    )
    each = rows.select(
        "row", "train", "verdict", F.explode(grams(F.concat("host", "path"), order)).alias("gram")
    )
    of = lambda verdict: F.sum((F.col("train") & (F.col("verdict") == verdict)).cast("long"))
    counts = written(
        each.groupBy("gram").agg(
            F.coalesce(of("allow"), F.lit(0)).alias("a"), F.coalesce(of("block"), F.lit(0)).alias("r"),
            F.sum((~F.col("train")).cast("long")).alias("n"),
        ),
        "url-grams",
    )
    scores = written(_estimates(counts, order), "url-scores")
    total = counts.select(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT_SHARE > total).select("gram")
    scored = written(
        skewed_join(each.where("not train").select("row", "gram"), scores, ["gram"], hot)
        .groupBy("row")
        .agg((F.sum("score") / F.count(F.lit(1))).alias("score")),
        "url-scored",
    )
    judged = rows.join(scored, "row", "left")
    labelled = rows.where("train").select("verdict").distinct().count()
    least = _threshold(judged.where("rule is not null and not train")) if labelled == 2 else -(1 << 62)
    verdict = F.coalesce("verdict", F.when(F.col("score") < least, "block").otherwise("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("score") / UNIT).alias("score"),
    )
