"""URL filter: rules first, then the ratio of two character language models.

The rules accept some URLs and reject others; these train one variable-order Markov model each, with Witten-Bell
smoothing from order ``ORDER`` down to none. The score of a URL is the difference of its two log-likelihoods over its
length. The threshold lies between the mean scores of accepted and rejected URLs, nearer to the class that varies
less, as found on held-out scores: every labelled URL is scored by the models of the other half of the hosts. All
labelled URLs are counted, so the models grow with the table.

URLs are modelled as host and path with digits written as 0, and each distinct one is counted and scored once, with its
number of rows as weight. Counts are joined, not collected: one row of two numbers reaches the driver. If one class
has no rows, the threshold is 0 and its model knows every symbol to be as likely: without accepted URLs mostly blocked,
without rejected ones mostly allowed.

A null URL or one without ``://`` has an empty host and path, meets no rule and is scored as the empty text. Each row
gives a row, equal ones equal rows, and an empty table none; a score at the threshold is allowed. The work is linear in
the length of a URL, whose places one task holds in memory at once. Only the id and URL columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import stored
from topicloom.operators.skew import join_weighted

ORDER = 4
#: Symbols a model spreads its last mass over: those of a byte.
SYMBOLS = 256
START, END = "\u0002", "\u0003"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Models by the half of the hosts they leave out; the last leaves out none.
ALL = 2
Rules = tuple[tuple[str, str, str], ...]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path columns."""
    at = F.locate("://", url)
    after = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    authority = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substring(after, F.length(authority) + 1, F.length(after))
    return F.translate(authority, UPPER, UPPER.lower()), F.regexp_extract(rest, "^[^?#]*", 0)


def matching_rule(rules: Rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule = verdict = F.when(F.lit(False), F.lit(""))
    for kind, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = rule.when(fits, F.lit(name + start)), verdict.when(fits, F.lit(kind))
    return rule, verdict


def _windows(urls: DataFrame, *kept: str) -> DataFrame:
    """A row for each symbol of a text: ``window``, the symbol with ``ORDER`` symbols before it.

    The text is cut in one pass and does not travel with the rows, so the work is linear in its length.
    """
    padded = F.concat(F.lit(START * ORDER), "text", F.lit(END))
    pattern = F.lit(f"(?s)(?=(.{{{ORDER + 1}}})).")
    return urls.select(*kept, F.explode(F.regexp_extract_all(padded, pattern, F.lit(1))).alias("window"))


def _orders(windows: DataFrame) -> DataFrame:
    """A row for each order: ``gram``, the symbol with ``n`` symbols before it."""
    return windows.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(ORDER)))).withColumn("gram", F.expr(f"substring(window, {ORDER + 1} - n, n + 1)"))


def train(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of symbols after contexts, and of contexts, for each class and model.

    ``labelled``: text, verdict, fold (0 or 1), rows.
    """
    windows = _windows(labelled, "verdict", "fold", "rows").groupBy("window", "verdict", "fold").agg(F.sum("rows").alias("rows"))
    counts = _orders(windows).groupBy("gram").agg(
        *(F.sum(F.when((F.col("verdict") == kind) & (F.col("fold") == fold), F.col("rows")).otherwise(0)).alias(f"{kind}{fold}") for kind in ("allow", "block") for fold in (0, 1))
    )
    # The model that leaves out a half has the counts of the other.
    models = [F.struct(F.lit(m).alias("model"), *((F.col(f"{kind}{1 - m}") if m != ALL else F.col(f"{kind}0") + F.col(f"{kind}1")).alias(kind) for kind in ("allow", "block"))) for m in (0, 1, ALL)]
    grams = stored(counts.select("gram", F.explode(F.array(*models)).alias("m")).select("gram", "m.*").filter("allow + block > 0"), "grams")
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    contexts = grams.groupBy("model", context.alias("context"), F.length("gram").alias("size")).agg(
        *(F.sum(kind).alias(f"{kind}_all") for kind in ("allow", "block")), *(F.count(F.when(F.col(kind) > 0, 1)).alias(f"{kind}_kinds") for kind in ("allow", "block"))
    )
    return grams, contexts


def _key(*columns: str) -> Column:
    return F.concat_ws(":", *columns)


def score(urls: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(text, model, score) of distinct (text, model); scores in millionths, as whole numbers, so that sums agree.

    The term of a symbol depends on the model and the window alone, so it is computed once for each distinct window.
    Short grams belong to very many windows and some windows to very many texts: both joins are salted by those counts.
    """
    texts = stored(urls.select("text", "model").withColumn("text_key", F.monotonically_increasing_id()), "texts")
    places = _windows(texts, "text_key", "model").groupBy("text_key", "model", "window").agg(F.count("*").alias("times"))
    places = stored(places.withColumn("key", _key("model", "window")), "places")
    windows = stored(places.groupBy("model", "window", "key").agg(F.count("*").alias("weight")), "windows")
    asked = _orders(windows.select("model", "window", "key")).withColumn("gram_key", _key("model", "gram"))

    wanted = asked.groupBy("model", "gram", "n", "gram_key").agg(F.count("*").alias("gram_weight"))
    wanted = wanted.withColumn("context", F.expr("substring(gram, 1, n)")).withColumn("size", F.col("n") + 1)
    # Of one context there are no more rows here than symbols after it, so no key of these two joins is hot.
    found = wanted.join(grams, ["model", "gram"], "left").join(contexts, ["model", "context", "size"], "left")
    numbers = [F.coalesce(F.col(f"{kind}{what}"), F.lit(0)).alias(f"{kind}{what}") for kind in ("allow", "block") for what in ("", "_all", "_kinds")]
    found = stored(found.select("gram_key", "gram_weight", F.struct("n", *numbers).alias("order")), "orders")
    rows = join_weighted(asked.select("key", "gram_key"), found, "gram_key", "gram_weight", ["key"])
    orders = rows.groupBy("key").agg(F.sort_array(F.collect_list("order")).alias("orders"))

    def log_likelihood(kind: str) -> Column:
        blend = lambda p, o: F.when(o[f"{kind}_all"] > 0, (o[kind] + o[f"{kind}_kinds"] * p) / (o[f"{kind}_all"] + o[f"{kind}_kinds"])).otherwise(p)
        return F.log(F.aggregate("orders", F.lit(1.0 / SYMBOLS), blend))

    difference = F.round((log_likelihood("allow") - log_likelihood("block")) * 1_000_000).cast("long")
    terms = stored(orders.select("key", difference.alias("d")).join(windows.select("key", "weight"), "key"), "terms")
    sums = join_weighted(places.select("text_key", "key", "times"), terms, "key", "weight", ["text_key"])
    scores = sums.groupBy("text_key").agg((F.sum(F.col("d") * F.col("times")) / F.sum("times")).alias("score"))
    return texts.join(scores, "text_key").select("text", "model", "score")


def threshold(scored: DataFrame) -> float:
    """Between the class means, in proportion to the deviations."""
    row = {}
    for r in scored.groupBy("verdict").agg(
        (F.sum(F.col("score") * F.col("rows")) / F.sum("rows")).alias("mean"),
        (F.sum(F.col("score") * F.col("score") * F.col("rows")) / F.sum("rows")).alias("square"),
    ).collect():
        row[r["verdict"]] = r["mean"], max(r["square"] - r["mean"] ** 2, 0.0) ** 0.5
    if len(row) < 2:
        return 0.0
    (high, wide), (low, narrow) = row["allow"], row["block"]
    return (high + low) / 2 if wide + narrow == 0 else (high * narrow + low * wide) / (wide + narrow)


def judge_urls(df: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of each row; the score is null where a rule decides."""
    host, path = url_parts(F.col(url_col))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    pages = df.select(F.col(id_col), host.alias("host"), path.alias("path"))
    pages = pages.withColumn("rule", rule).withColumn("by_rule", verdict)
    pages = pages.withColumn("text", F.regexp_replace(F.concat("host", "path"), "[0-9]", "0"))
    texts = stored(pages.groupBy("text", "by_rule", F.when(F.col("by_rule").isNotNull(), F.pmod(F.xxhash64("host"), F.lit(2)).cast("int")).alias("fold")).agg(F.count("*").alias("rows")), "urls")
    labelled = texts.filter("by_rule IS NOT NULL").withColumnRenamed("by_rule", "verdict")
    grams, contexts = train(labelled)
    contexts = stored(contexts, "contexts")
    own = F.coalesce("fold", F.lit(ALL)).alias("model")
    scored = stored(score(texts.select("text", own).distinct(), grams, contexts), "scores")
    held_out = labelled.withColumnRenamed("fold", "model").join(scored, ["text", "model"])
    bar = threshold(held_out)
    free = scored.filter(F.col("model") == ALL).select("text", "score")
    found = pages.withColumn("asked", F.when(F.col("by_rule").isNull(), F.col("text")))
    # Rows that a rule has decided need no score and are dealt out at random.
    found = found.withColumn("asked", F.coalesce("asked", F.concat(F.lit(START), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)).cast("string"))))
    found = found.join(free.withColumnRenamed("text", "asked"), "asked", "left")
    by_model = F.when(F.col("score") >= bar, "allow").otherwise("block")
    return found.select(id_col, "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
