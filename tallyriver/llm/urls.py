"""URL filter: host and path rules, and a character language-model ratio for what no rule decides.

Two variable-order Markov models, one of accepted and one of rejected URLs, share one table of character n-grams over
whole URLs, every code point as it is. A character's probability after its longest context is interpolated with that
after each shorter one (Witten-Bell), and an unseen context passes the shorter one's probability on. A URL's score is
the difference of both log-likelihoods divided by its length; the threshold is calibrated on labelled URLs that the
models have not seen. All URLs that a rule decides are labelled by it, and all of them outside the calibrating fold are
counted. The n-gram table grows with the corpus and meets the URLs by shuffle. DataFrame functions only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import HELD_OUT_FOLDS, renamed
from tallyriver.storage import shared_folder

#: Longest context in characters.
DEPTH = 6
START, END, ESCAPE = "\x02", "\x03", "\x01"
#: N-grams that make up more than this part of all are broadcast, so at most as many; the others meet by shuffle.
COMMON = 20_000
BIN = 0.02
BINS = 500


class Rule(NamedTuple):
    """``host`` fits itself and all subdomains, ``path`` whatever starts with it."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The number of the longest fitting rule, null if none fits; of equally long ones the first."""
    longest = sorted(range(len(rules)), key=lambda i: -len(rules[i].host + rules[i].path))
    found = F.lit(None).cast("int")
    for i in reversed(longest):
        rule = rules[i]
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(i)).otherwise(found)
    return found


def _marked(url: Column) -> Column:
    """The url between start marks and an end mark; a url's own marks are spelled as two characters."""
    text = F.coalesce(url, F.lit(""))
    for mark, letter in ((ESCAPE, "a"), (START, "b"), (END, "c")):
        text = F.replace(text, F.lit(mark), F.lit(ESCAPE + letter))
    return F.concat(F.lit(START * DEPTH), text, F.lit(END))


def _grams(rows: DataFrame) -> DataFrame:
    """One row for each character of ``url`` and its end, with its context before it: together they are ``gram``."""
    # the match takes one code point at a time, so the work grows with a url's length, not with its square
    grams = F.regexp_extract_all(_marked(F.col("url")), F.lit(f"(?s)(?=(.{{{DEPTH + 1}}})).|."), F.lit(1))
    # explode() would have Spark repeat the matching in a filter below it; explode_outer() does not
    return rows.withColumn("gram", F.explode_outer(grams)).filter("gram <> ''")


def _last(gram: Column) -> Column:
    return F.substring(gram, -1, 1)


def ratio_table(counted: DataFrame) -> DataFrame:
    """``gram`` and ``ratio``: log of the rejected over the accepted model's probability of its last character.

    ``counted`` has one row for each n-gram of all URLs, all of one length, with its counts ``good`` and ``bad``. Both
    classes are scaled to the same total and leave room for unseen characters by the followers that either has seen, so
    that what neither knows speaks for neither. Without counts of one class all ratios are 0.
    """
    spark = counted.sparkSession
    totals = counted.agg(F.sum("good"), F.sum("bad"), F.max(F.length("gram")), F.count_distinct(_last(F.col("gram")))).first()
    good, bad, longest, letters = totals
    if not good or not bad:
        return counted.select("gram", F.lit(0.0).alias("ratio"))
    weights = {"good": (good + bad) / (2 * good), "bad": (good + bad) / (2 * bad)}
    # every n-gram's ends of one character and more, so that each depth's counts come from one combining aggregation
    ends = F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.substring(F.col("gram"), -n, n))
    followers, fields = shared_folder(spark, "url-followers"), "gram string, depth int, good bigint, bad bigint"
    each = counted.select(F.posexplode(ends).alias("depth", "gram"), "good", "bad")
    each = each.groupBy("gram", "depth").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    each.write.parquet(followers)
    keyed = spark.read.schema(fields).parquet(followers).withColumn("context", F.substring(F.col("gram"), F.lit(1), F.col("depth")))
    contexts = keyed.groupBy("context", "depth").agg(
        *[F.sum(s).alias(f"n_{s}") for s in weights], F.count_if(F.col("good") + F.col("bad") > 0).alias("kinds")
    )
    levels = shared_folder(spark, "url-levels")
    placed = keyed.join(contexts, ["context", "depth"]).select("gram", "depth", *weights, *[f"n_{s}" for s in weights], "kinds")
    placed.write.parquet(levels)
    placed = spark.read.schema(placed.schema).parquet(levels)

    def mixed(s: str) -> Column:
        seen, all_ = F.col(s) * F.lit(weights[s]), F.col(f"n_{s}") * F.lit(weights[s])
        p = (seen + F.col("kinds") * F.col(f"p_{s}")) / (all_ + F.col("kinds"))
        return F.when(F.col("kinds") > 0, p).otherwise(F.col(f"p_{s}"))

    shorter = None
    for depth in range(longest):
        level = placed.filter(F.col("depth") == depth)
        if shorter is None:
            level = level.withColumns({f"p_{s}": F.lit(1.0 / letters) for s in weights})
        else:
            level = level.withColumn("end", F.substring("gram", -depth, depth)).join(shorter, "end")
        shorter = level.select(F.col("gram").alias("end"), *[mixed(s).alias(f"p_{s}") for s in weights])
    return shorter.select(F.col("end").alias("gram"), (F.log("p_bad") - F.log("p_good")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The bin border with the least sum of both classes' error shares on the calibrating fold; 0 without both."""
    held = scored.filter("calibrates and good is not null")
    cell = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN))).cast("int").alias("cell")
    # at most one row for each cell
    cells = sorted(held.groupBy(cell).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).collect())
    good, bad = sum(c["good"] for c in cells), sum(c["bad"] for c in cells)
    if not good or not bad:
        return 0.0
    best, lost_good, lost_bad = None, good, 0
    for border in range(-BINS, BINS + 1):
        here = [c for c in cells if c["cell"] == border - 1]
        lost_good, lost_bad = lost_good - sum(c["good"] for c in here), lost_bad + sum(c["bad"] for c in here)
        value = (lost_good / good + lost_bad / bad, abs(border))
        best = min(best, (*value, border)) if best else (*value, border)
    return best[2] * BIN


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Every page's ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and, for all pages, the models' ``score``.

    ``rule`` is the longest rule that fits, as host and path, or null. ``verdict`` is its verdict; without a rule,
    ``block`` if the score lies above the calibrated threshold, else ``allow``.

    Defined cases: a null url, or one without ``://``, has an empty host and path; the score of a null or empty url is
    that of the end mark alone. Rows that repeat an id come back as often, each by its own url; null ids too. Without a labelled url
    of either kind the models are even, every score is 0 and the verdict is ``allow``. Further columns are ignored; an
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    source = renamed(pages, id=id_col, url=url_col)
    each = source.groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    judged = each.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    good = F.when(F.col("rule").isNotNull(), F.get(verdicts, F.col("rule")) == "allow")
    judged = judged.withColumns(
        {
            "good": good,
            "calibrates": F.crc32(F.concat("host", "path").cast("binary")) % HELD_OUT_FOLDS == 0,
            # a stored number, so that a url's characters need not carry its row
            "key": F.monotonically_increasing_id(),
        }
    )
    path = shared_folder(spark, "urls")
    judged.write.parquet(path)
    judged = spark.read.schema(judged.schema).parquet(path)

    learns = ~F.col("calibrates")
    counts = shared_folder(spark, "url-grams")
    counted = _grams(judged.select("url", "good", "calibrates", "copies")).groupBy("gram").agg(
        F.sum(F.when(learns & F.col("good"), F.col("copies")).otherwise(0)).alias("good"),
        F.sum(F.when(learns & ~F.col("good"), F.col("copies")).otherwise(0)).alias("bad"),
        F.count(F.lit(1)).alias("times"),
    )
    counted.write.parquet(counts)
    counted = spark.read.schema("gram string, good bigint, bad bigint, times bigint").parquet(counts)
    stored = shared_folder(spark, "url-ratios")
    ratio_table(counted.drop("times")).join(counted.select("gram", "times"), "gram").write.parquet(stored)
    ratios = spark.read.schema("gram string, ratio double, times bigint").parquet(stored)
    least = (counted.agg(F.sum("times")).first()[0] or 0) / COMMON

    # common n-grams stay where they are, so that no key of the shuffle is large; a url's characters are added up
    # before the result meets its row again
    spelled = _grams(judged.select("key", "url")).select("key", "gram")
    common = F.broadcast(ratios.filter(F.col("times") > least).select("gram", "ratio"))
    rare = ratios.filter(F.col("times") <= least).select("gram", "ratio")
    met = spelled.join(common, "gram").select("key", "ratio").groupBy("key").agg(F.sum("ratio").alias("sum"), F.count("ratio").alias("n"))
    left = spelled.join(common, "gram", "left_anti").join(rare, "gram").select("key", F.col("ratio").alias("sum"), F.lit(1).cast("bigint").alias("n"))
    scores = met.unionByName(left).groupBy("key").agg((F.sum("sum") / F.sum("n")).alias("score"))
    scored = judged.join(scores, "key").select(*[c for c in judged.columns if c != "key"], "score")
    results = shared_folder(spark, "url-scores")
    scored.write.parquet(results)
    scored = spark.read.schema(scored.schema).parquet(results)
    threshold = _threshold(scored)

    names = F.array(*[F.lit(r.host + r.path) for r in rules]) if rules else F.array().cast("array<string>")
    by_model = F.when(F.col("score") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    whole = scored.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return whole.select(
        F.col("id").alias("page_id"),
        "host",
        "path",
        F.get(names, F.col("rule")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("rule")), by_model).alias("verdict"),
        "score",
    )
