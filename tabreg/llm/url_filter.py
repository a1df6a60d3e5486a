"""URL filter by the likelihood ratio of two character models.

Rules settle some urls; these train two variable-order Markov models, one of
accepted and one of rejected urls. A character's probability after five others
is smoothed with that after four, and so on, so a context counts as far as it
was seen. The mean log likelihood difference per character is compared with a
threshold calibrated on settled urls the models have not seen. Built from SQL
functions only: all work is on the table of distinct character sequences and
on sums by url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import cut, lookup_join

ORDER = 5  # characters of context
PRIOR = 1.0  # weight of the shorter context
CALIBRATION = 5  # one of so many settled urls calibrates
BIN = 0.01
_START = "\u0001"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; null or none: empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; null or no ``://``: empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of the rules (``host/path``) that fits a url's host, or a parent of it, and path; or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, start = rule.partition("/")
        out = F.when(((host == name) | host.endswith("." + name)) & path.startswith("/" + start), F.lit(rule)).otherwise(out)
    return out


def _grams(urls: DataFrame, keep: list[str], order: int) -> DataFrame:
    """``keep`` and gram: every character of text with the ``order`` before it."""
    padded = F.concat(F.lit(_START * order), F.col("text"))
    at = F.explode(F.when(F.length("text") > 0, F.sequence(F.lit(1), F.length("text"))).otherwise(F.array().cast("array<int>")))
    return urls.select(*keep, padded.alias("_p"), at.alias("_i")).select(*keep, F.substring("_p", F.col("_i"), F.lit(order + 1)).alias("gram"))


def character_models(urls: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """gram, ratio: log probability of a gram's last character among accepted urls less that among rejected.

    ``urls``: text, good (boolean; null: in no model, but its grams get a ratio).
    """
    grams = (_grams(urls, ["good"], order).groupBy("gram")
             .agg(F.count_if(F.col("good")).alias("n1"), F.count_if(~F.col("good")).alias("n0")))
    full = cut(grams, "url-grams")
    single = full.groupBy(F.substring("gram", order + 1, 1).alias("gram")).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    total = single.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count(F.lit(1)).alias("v")).first()
    shorter = single.select("gram", *[((F.col(f"n{c}") + 1.0) / F.lit(float((total[f"n{c}"] or 0) + total["v"] + 1))).alias(f"p{c}") for c in (1, 0)])
    for k in range(1, order + 1):
        grams = full if k == order else full.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram")).agg(
            F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        context = Window.partitionBy("_c")  # as many rows as there are characters, at most
        grams = (grams.withColumn("_c", F.substring("gram", 1, k)).withColumn("_s", F.substring("gram", 2, k))
                 .withColumns({f"m{c}": F.sum(f"n{c}").over(context) for c in (1, 0)}))
        longer = grams.alias("g").join(shorter.alias("s"), F.col("g._s") == F.col("s.gram"))
        shorter = cut(longer.select("g.gram", *[((F.col(f"n{c}") + prior * F.col(f"p{c}")) / (F.col(f"m{c}") + prior)).alias(f"p{c}")
                                                for c in (1, 0)]), "url-model")
    return shorter.select("gram", (F.log("p1") - F.log("p0")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The score that best separates good from bad (mean of both rates), on a grid of BIN; 0 if one is missing."""
    at = F.round(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col("score"))) / BIN).cast("int")
    bins = scored.groupBy(at.alias("bin")).agg(F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad"))
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # 2001 rows at most
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    rates = bins.select("bin", F.sum("good").over(every).alias("g"), F.sum("bad").over(every).alias("b"),
                        F.coalesce(F.sum("good").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("bad").over(below), F.lit(0)).alias("caught"),
                        F.lag("bin").over(Window.orderBy("bin")).alias("before"))
    rates = rates.where("g > 0 and b > 0").withColumn("rate", 1 - F.col("lost") / F.col("g") + F.col("caught") / F.col("b"))
    best = rates.orderBy(F.desc("rate"), F.abs("bin"), "bin").limit(1).collect()
    return 0.0 if not best else (best[0]["bin"] + (best[0]["bin"] if best[0]["before"] is None else best[0]["before"])) / 2 * BIN


def judge(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url", order: int = ORDER) -> DataFrame:
    """key, host, path, rule, verdict, score for every row of ``pages``.

    ``rules``: {``host/path``: ``allow`` or ``block``}. A url that no rule
    fits is allowed if its score is the threshold or more. A null or empty url
    scores 0. Without urls of both kinds to calibrate on, the threshold is 0.
    Equal urls are judged alike and counted once in the models; repeated rows
    stay. An empty table gives no rows; further columns are not read.
    """
    rows = pages.select(F.col(key).alias("_key"), F.coalesce(F.col(url), F.lit("")).alias("_url"))
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    says = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        says = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(says)
    rows = rows.withColumn("_says", says)
    text = F.lower(F.regexp_replace("_url", r"^[^/?#]*?://", ""))
    fresh = F.pmod(F.crc32(F.col("_url").cast("binary")), F.lit(CALIBRATION)) == 0
    urls = cut(rows.select("_url", text.alias("text"), (F.col("_says") == "allow").alias("settled"), fresh.alias("fresh")).distinct(), "urls")
    model = character_models(urls.select("text", F.when(~F.col("fresh"), F.col("settled")).alias("good")), order)
    model = cut(model, "url-ratios")
    found = lookup_join(_grams(urls, ["_url"], order), model, ["gram"], model.count())
    sums = found.groupBy("_url").agg(F.avg("ratio").alias("score"))
    scored = cut(sums.join(urls.select("_url", "settled", "fresh"), "_url", "right")
                 .select("_url", F.coalesce("score", F.lit(0.0)).alias("score"), "settled", "fresh"), "url-scores")
    limit = _threshold(scored.where(F.col("fresh") & F.col("settled").isNotNull()).select("score", F.col("settled").alias("good")))
    out = rows.join(scored.select("_url", "score"), "_url")
    verdict = F.coalesce("_says", F.when(F.col("score") >= F.lit(limit), "allow").otherwise("block"))
    return out.select(F.col("_key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "score")
