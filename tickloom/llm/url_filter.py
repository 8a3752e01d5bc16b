"""URL filters: a list of host and path rules, then association rules mined from labelled URLs.

1. A URL is taken apart into host, path and tokens: scheme, host and its suffixes, path segments, query
   parts and fragment, with runs of digits as one 0.
2. Spark's FP-growth mines token combinations from labelled URLs, each a transaction with the token `BAD` if
   its label is bad. Combinations that imply `BAD` often enough become rules; their support and confidence are
   counted again over the whole tokens, and a rule goes if a part of it is as sure.
3. Rules are indexed under their rarest token. URLs look up their tokens there, and a rule that lies wholly in
   the URL's tokens matches. A URL that any rule matches is blocked, if the list does not judge it.

Only the mining is bounded: it takes `MOST_LABELLED` labelled URLs (thinned by a hash of the URL where there are more)
and of each the `MOST_TOKENS` tokens with the worst labels, as a URL of m tokens holds 2**m combinations. Every URL is
matched against every rule, once per distinct URL.

- A null URL, or one without `://`, has an empty host and path and no tokens; list rules do not fit it and it is allowed.
- Repeated rows and null ids come out as they went in; equal URLs have equal verdicts, and count once in mining (as
  bad if any is). Labels that are null count as good. Columns other than those named are not read. Without bad
  URLs there are no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.textual import fresh_name
from tickloom.session import stage

#: (verdict, host, path); the longest that fits wins, of equally long ones that with the longer host.
LIST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT = 10  # bad URLs that a rule must hold for
MIN_CONFIDENCE = 0.5
MOST_LABELLED = 200_000
MOST_TOKENS = 10
SUFFIXES = 4  # labels of a host that its suffixes reach to
BAD = "label:bad"
THINNING = 1 << 20


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL."""
    text = F.coalesce(url, F.lit(""))
    labels = F.split(host_of(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(SUFFIXES))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    query = F.regexp_extract(text, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(text, r"(?s)^.*?://[^#]*#(.*)$", 1)
    kinds = {
        "s:": F.array(F.regexp_extract(text, r"(?s)^(.*?)://", 1)),
        "h:": F.concat(suffixes, F.array(host_of(url))),
        "p:": F.split(path_of(url), "/"), "q:": F.split(query, "&"), "f:": F.array(fragment),
    }

    def named(kind: str, parts: Column) -> Column:
        whole = kind in ("s:", "h:")
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x if whole else F.regexp_replace(x, "[0-9]+", "0")))

    return F.when(F.instr(text, "://") > 0, F.array_distinct(F.concat(*(named(*x) for x in kinds.items())))).otherwise(F.array().cast("array<string>"))


def list_verdict(host: Column, path: Column, rules=LIST_RULES) -> tuple[Column, Column]:
    """The rule of the list that judges a URL, and its verdict; null if none fits."""
    first = sorted(rules, key=lambda x: (-len(x[1] + x[2]), -len(x[1])))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in first]
    pick = lambda values: F.coalesce(F.lit(None).cast("string"), *(F.when(fit, F.lit(x)) for fit, x in zip(fits, values)))
    return pick([h + p for _, h, p in first]), pick([verdict for verdict, _, _ in first])


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Pairs of a row of `urls` (with `tokens`) and a row of `rules` (`anchor`, `items`) whose items are all among
    the tokens. A rule is looked up under its anchor only, so a frequent token brings no pairs by itself."""
    looked_up = urls.withColumn("anchor", F.explode("tokens")).join(rules, "anchor")
    return looked_up.where(F.size(F.array_except("items", "tokens")) == 0)


def measured(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules with `support` (bad URLs that they match) and `confidence` (their share of all that they match)."""
    hits = matches(urls, rules).groupBy("rule", "anchor", "items").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("support"))
    return hits.withColumn("confidence", F.col("support") / F.col("n")).drop("n")


def mined_rules(
    labelled: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    most_labelled: int = MOST_LABELLED, most_tokens: int = MOST_TOKENS,
) -> DataFrame:
    """Rules for bad URLs from `labelled` (`url`, `bad` as 0 or 1): `rule` (its items as text), `anchor`, `items`,
    `support` and `confidence`."""
    spark = labelled.sparkSession
    kind = "rule string, anchor string, items array<string>, support long, confidence double"
    once = stage(labelled.where("url IS NOT NULL").groupBy("url").agg(F.max(F.coalesce("bad", F.lit(0)).cast("long")).alias("bad")), "labelled-urls")
    n = once.count()
    if n > most_labelled:
        once = once.where(F.pmod(F.xxhash64("url"), F.lit(THINNING)) < most_labelled * THINNING // n)
    urls = stage(once.select("url", "bad", tokens_of(F.col("url")).alias("tokens")), "labelled-tokens")
    spread = urls.select("url", "bad", F.explode("tokens").alias("token"))
    worth = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad")).where(F.col("n_bad") >= min_support)
    worth = stage(worth, "tokens")
    telling = Window.partitionBy("url").orderBy(F.desc(F.col("n_bad") / F.col("n")), F.desc("n_bad"), "token")
    chosen = spread.join(worth, "token").withColumn("place", F.row_number().over(telling)).where(F.col("place") <= most_tokens)
    baskets = chosen.groupBy("url", "bad").agg(F.collect_list("token").alias("items"))
    baskets = stage(baskets.select(F.when(F.col("bad") > 0, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")), "baskets")
    size = baskets.count()
    if not size:
        return spark.createDataFrame([], kind)
    # Half a count less than wanted, so that rounding the share back to a count gives the count.
    model = FPGrowth(itemsCol="items", minSupport=min((min_support - 0.5) / size, 1.0), minConfidence=min_confidence).fit(baskets)
    implied = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    implied = implied.select(F.array_sort("antecedent").alias("items")).withColumn("rule", F.array_join("items", " "))
    rarest = implied.select("rule", "items", F.explode("items").alias("token")).join(worth, "token")
    indexed = stage(rarest.groupBy("rule", "items").agg(F.min(F.struct("n", "token"))["token"].alias("anchor")), "rules")
    sure = measured(indexed, urls).where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
    sure = stage(sure.select("rule", "anchor", "items", "support", "confidence"), "sure-rules")
    # A rule within another that is as sure makes the longer one needless.
    longer = sure.select(F.col("rule").alias("whole"), F.col("items").alias("tokens"), F.col("confidence").alias("reached"))
    needless = matches(longer, sure).where((F.col("rule") != F.col("whole")) & (F.col("confidence") >= F.col("reached")))
    return stage(sure.join(needless.select(F.col("whole").alias("rule")).distinct(), "rule", "left_anti"), "url-rules")


def labels_of_pages(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs with labels: the last number of a page's path names the document it shows; `bad` is a document of
    low quality or a toxic one."""
    number = F.regexp_extract(path_of(F.col(f"`{url_col}`")), "([0-9]{1,18})[^0-9]*$", 1)
    urls = pages.select(F.col(f"`{url_col}`").alias("url"), F.when(number != "", number.cast("long")).alias("doc_id"))
    judged = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).cast("int")).alias("bad"))
    return urls.where("doc_id IS NOT NULL").join(judged, "doc_id").select("url", "bad")


def judge(pages: DataFrame, rules: DataFrame, carry: list[str], url_col: str = "url", list_rules=LIST_RULES) -> DataFrame:
    """The columns of `carry` with `host`, `path`, `rule` (of the list), `verdict`, and `mined` and `confidence` of the
    surest mined rule that matches."""
    names = {x: fresh_name(carry, x) for x in ("host", "path", "rule", "verdict", "mined", "confidence", "_url")}
    url = F.col(names["_url"])
    rows = pages.select(*(F.col(f"`{x}`") for x in carry), F.col(f"`{url_col}`").cast("string").alias(names["_url"]))
    distinct = rows.select(url.alias("url")).where("url IS NOT NULL").distinct().withColumn("tokens", tokens_of(F.col("url")))
    best = F.max_by(F.struct("rule", "confidence"), F.struct("confidence", "support", "rule")).alias("best")
    hits = stage(matches(distinct, rules).groupBy("url").agg(best), "url-hits")
    hits = hits.select(F.col("url").alias("_hit"), F.col("best.rule").alias("_rule"), F.col("best.confidence").alias("_sure"))
    rows = rows.withColumns({names["host"]: host_of(url), names["path"]: path_of(url)})
    rule, verdict = list_verdict(F.col(names["host"]), F.col(names["path"]), list_rules)
    rows = rows.join(hits, url == F.col("_hit"), "left")
    otherwise = F.when(F.col("_hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumns({
        names["rule"]: rule, names["verdict"]: F.coalesce(verdict, otherwise), names["mined"]: F.col("_rule"), names["confidence"]: F.col("_sure"),
    }).select(*(F.col(f"`{x}`") for x in carry), *(names[x] for x in ("host", "path", "rule", "verdict", "mined", "confidence")))
