"""URL filter by listed and mined rules (operator 1).

Listed rules (host and path prefix) decide first.  Other urls are judged by
association rules: FP-growth mines combinations of url tokens in the rows
labelled "block"; their antecedents are counted over all labelled rows; rules
are pruned by support, confidence and redundancy, and matched through an
inverted index from each rule's rarest token.  Itemsets, rules and the index
are tables, so their number is not bounded by the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.shared import fresh, pick, saved, table

# The listed rules of the registered query: fixed values.
LISTED = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
          ("net/es/", "block"), ("net/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """``host, path, tail`` of a url; empty for NULL or without ``://``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case.  Path: from there up to ``?``, ``#`` or the end.  Tail: the rest.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"^[^?#]*([?#](?s).*)$", 1)
    return F.translate(host, _UPPER, _LOWER), path, tail


def listed_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]] = LISTED) -> Column:
    """``struct<rule, verdict>`` of the longest listed rule that fits, else NULL.

    A rule ``host/path`` fits its host and all subdomains where the url's path
    starts with the rule's; of equally long ones the first wins.  One ordered
    conditional expression, for lists of up to some hundred rules.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(reversed(list(rules)), key=lambda r: len(r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, tail: Column) -> Column:
    """Distinct tokens of a url: host labels and their parts at ``-``, the last
    two labels, path segments (numbers as ``#``), file ending, query keys."""
    number = lambda x: F.when(x.rlike(r"^\d+$"), F.lit("#")).otherwise(x)
    named = lambda xs, kind, f=None: F.transform(
        F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), f(x) if f else x))
    lower = F.lower(path)
    ending = F.regexp_extract(lower, r"\.([a-z0-9]{1,5})$", 1)
    segments = F.split(F.regexp_replace(lower, r"\.[a-z0-9]{1,5}$", ""), "/")
    keys = F.transform(F.split(F.regexp_extract(tail, r"^\?([^#]*)", 1), "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    return F.array_distinct(F.concat(
        named(F.split(host, r"\."), "host"), named(F.split(host, r"[.-]"), "part"),
        named(F.array(F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)), "site"),
        named(segments, "path", number), named(F.array(ending), "end"), named(keys, "key")))


def merged_tokens(rows: DataFrame) -> DataFrame:
    """``token, item``: tokens that stand in the same rows of ``id, tokens`` are one item.

    Rows are compared by two sums of row hashes; an item is named by its least
    token.  A rule needs one token of an item only, as the others always come
    with it.
    """
    one = rows.select("id", F.explode("tokens").alias("token"))
    by_token = one.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("h1"),
                                        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("h2"))
    names = by_token.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"))
    return by_token.join(names, ["n", "h1", "h2"]).select("token", "item")


def _with_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` (``id, tokens`` ...) with their distinct items; a token that is not listed is none."""
    got = rows.select("id", F.explode("tokens").alias("token")).join(items, "token")
    got = got.groupBy("id").agg(F.collect_set("item").alias("items"))
    return rows.join(got, "id")


def mine_rules(labelled: DataFrame, tokens: str = "tokens", block: str = "block", min_count: int = 20,
               min_confidence: float = 0.5, min_lift: float = 1.5, max_tokens: int = 3) -> DataFrame:
    """``tokens, confidence, support``: rules "these tokens, so block".

    ``labelled`` has token arrays and ``block`` 0/1.  Kept: rules of at most
    ``max_tokens`` items on at least ``min_count`` bad rows, whatever the
    number of rows, with the confidence and lift asked for, of which no part
    has at least the same confidence.

    Only bad rows are mined.  Tokens with equal row sets are one item; a token
    on fewer bad rows than ``min_count`` is none.  So tokens that always come
    together cost FP-growth one item, and a site with very many of them no
    more than one.  What is found is then counted over all rows.  Rows with
    NULL label or without tokens say nothing; no rows: no rules.
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(block).isNotNull() & (F.size(tokens) > 0)).select(
        F.monotonically_increasing_id().alias("id"), F.array_distinct(tokens).alias("tokens"), F.col(block).cast("int").alias("block"))
    rows = saved(rows, "url-rows")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("block"), F.lit(0))).first()
    nothing = spark.createDataFrame([], "tokens array<string>, confidence double, support bigint")
    if n_bad < min_count:
        return nothing
    bad = rows.filter("block = 1")
    frequent = bad.select(F.explode("tokens").alias("token")).groupBy("token").count().filter(F.col("count") >= min_count)
    items = merged_tokens(rows).join(frequent.select("token"), "token", "left_semi")
    rows = saved(_with_items(rows, saved(items, "url-items")).select("id", "items", "block"), "url-item-rows")
    if rows.filter("block = 1").isEmpty():
        return nothing
    mined = rows.filter("block = 1").select("items")
    model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n_bad).fit(mined)
    sets = model.freqItemsets.filter((F.size("items") <= max_tokens) & (F.col("freq") >= min_count))
    sets = saved(sets.select(F.sort_array("items").alias("tokens"), F.col("freq").alias("support")), "url-itemsets")
    seen = contained(rows.select("id", F.col("items").alias("have")), sets, "id")
    counted = seen.groupBy("tokens", "support").agg(F.count(F.lit(1)).alias("n"))
    rules = saved(counted.select("tokens", (F.col("support") / F.col("n")).alias("confidence"), "support"), "url-rules")
    fit = rules.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") / F.lit(n_bad / n) >= min_lift))
    # Proper parts: the masks between nothing and all of a rule's few items.
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("tokens")) - 2)
    part = lambda m: F.filter("tokens", lambda _, i: F.call_function("getbit", m, i) == 1)
    parts = fit.filter("size(tokens) > 1").select("tokens", "confidence", F.explode(F.transform(masks, part)).alias("part"))
    better = fit.select(F.col("tokens").alias("part"), F.col("confidence").alias("of_part"))
    redundant = parts.join(better, "part").filter("of_part >= confidence").select("tokens").distinct()
    return saved(fit.join(redundant, "tokens", "left_anti").select("tokens", "confidence", "support"), "url-rules")


def contained(rows: DataFrame, sets: DataFrame, key: str) -> DataFrame:
    """Pairs of a row (``key, have``) and a set (``tokens`` ...) that lies in it.

    An inverted index: a set stands under its rarest token, by the sets that
    use it; a row looks under each of its tokens, and the rest of the set is
    tested where they meet.
    """
    uses = sets.select("tokens", F.explode("tokens").alias("token"))
    count = uses.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    rare = uses.join(count, "token").groupBy("tokens").agg(F.min(F.struct("uses", "token")).alias("rare"))
    index = sets.join(rare, "tokens").withColumn("under", F.col("rare.token")).drop("rare")
    look = rows.select(key, "have", F.explode("have").alias("at"))
    inside = (look["at"] == index["under"]) & (F.size(F.array_except("tokens", "have")) == 0)
    return look.join(index, inside).drop("at", "under", "have")


def match_rules(rows: DataFrame, rules: DataFrame, tokens: str, name: str) -> DataFrame:
    """``rows`` with the mined rule of highest confidence (then greatest name)
    whose tokens are all there, as a column ``name``; NULL where none is.

    Equal token arrays are matched once, by the tokens that rules use.
    """
    if rules.isEmpty():
        return rows.withColumn(name, F.lit(None).cast("string"))
    key, have, rule = fresh(rows, "token_key", "token_have", "token_rule")
    rows = rows.withColumn(key, F.xxhash64(F.col(f"`{tokens}`")))
    arrays = rows.filter(F.size(f"`{tokens}`") > 0).groupBy(F.col(key).alias("id")).agg(F.first(f"`{tokens}`").alias("tokens"))
    used = rules.select(F.explode("tokens").alias("token")).distinct().select("token", F.col("token").alias("item"))
    arrays = _with_items(arrays, used).select(F.col("id").alias("key"), F.col("items").alias("have"))
    hits = contained(arrays, rules, "key")
    text = F.array_join("tokens", " & ")
    best = hits.groupBy("key").agg(F.max(F.struct("confidence", text.alias("rule"))).alias("best"))
    best = best.select(F.col("key").alias(have), F.col("best.rule").alias(rule))
    return rows.join(best, F.col(key) == F.col(have), "left").withColumn(name, F.col(rule)).drop(key, have, rule)


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url",
               label_id: str = "doc_id", listed: Iterable[tuple[str, str]] = LISTED, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule`` of every row.

    ``labels`` are matched by id; a page is a "block" example if one of its
    labels has quality 0 or toxic 1.  NULL or odd urls have empty host and
    path, fit no rule and are allowed, as is every url that no rule blocks.
    Repeated rows and NULL ids are judged like others; a very long url is read
    whole, with all its tokens; of equally confident rules the greatest name
    wins.  Extra columns are left out; an empty table gives no rows, and
    without labels there is no mined rule.
    """
    p = pick(pages, page_id=page_id, url=url)
    host, path, tail = url_parts(F.col("url"))
    p = p.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail"))
    p = p.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.col("tail")))
    seen = (labels.filter(F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").alias("label_id"))
            .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("block")))
    rules = mine_rules(p.join(seen, p.page_id == seen.label_id).select("tokens", "block"), **options)
    fits, mined = fresh(p, "fits", "mined")
    p = p.withColumn(fits, listed_rule(F.col("host"), F.col("path"), listed))
    p = match_rules(p, rules, "tokens", mined)
    mined_verdict = F.when(F.col(mined).isNotNull(), "block").otherwise("allow")
    return p.select("page_id", "host", "path", F.col(f"{fits}.rule").alias("rule"),
                    F.coalesce(F.col(f"{fits}.verdict"), mined_verdict).alias("verdict"),
                    F.when(F.col(fits).isNull(), F.col(mined)).alias("mined_rule"))


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
