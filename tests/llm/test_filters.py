"""Url rules, quality rules and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from meterlake.llm import chat, quality, url_rules
from odd_documents import documents, empty, odd  # noqa: F401


# --- url rules ----------------------------------------------------------------

def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    best = None
    for rule, _ in url_rules.LISTED:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best or ""):
            best = rule
    return host, path, best


URLS = [None, "", "x", "http://A.Com", "http://a.com?x=/y", "ftp://É.COM/a b?#", "http://x.net/es/1", "://", "a://://y",
        "https://WWW.Example.com/en/5", "https://m.example.com/en/", "http://example.com/en", "http://net/fr/#/en/",
        "http://notnet/es/", "http://a.example.com/en/\nx", "HTTP://com/", "http://example.comx/en/"]


def test_url_parts_and_listed_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    host, path, _ = url_rules.url_parts(F.col("url"))
    got = pages.select("url", host.alias("h"), path.alias("p")).select(
        "url", "h", "p", url_rules.listed_rule(F.col("h"), F.col("p")).alias("r"))
    for r in got.collect():
        assert (r.h, r.p, r.r and r.r.rule) == plain_url(r.url), r.url
        assert r.r is None or r.r.verdict == dict(url_rules.LISTED)[r.r.rule]


def test_url_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    rows = {r.page_id: r for r in url_rules.op1_url_rules(spark, SF_SMALL).collect()}
    assert len(rows) == len(pages)
    for p in pages:
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == plain_url(p.url)
        listed = dict(url_rules.LISTED).get(r.rule)
        assert r.verdict == (listed or ("block" if r.mined_rule else "allow"))


def plain_rules(rows, min_count, min_confidence, min_lift, max_tokens):
    n = len(rows)
    base = sum(b for _, b in rows) / n
    counts, bad = {}, {}
    for tokens, b in rows:
        for k in range(1, max_tokens + 1):
            for s in itertools.combinations(sorted(set(tokens)), k):
                counts[s] = counts.get(s, 0) + 1
                bad[s] = bad.get(s, 0) + b
    fit = {s: bad[s] / c for s, c in counts.items()
           if bad[s] >= min_count and bad[s] / c >= min_confidence and bad[s] / c / base >= min_lift}
    below = lambda s: max((fit[t] for k in range(1, len(s)) for t in itertools.combinations(s, k) if t in fit), default=0.0)
    return {s: c for s, c in fit.items() if c > below(s)}


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        tokens = rng.sample(["a", "b", "c", "d", "e"], rng.randint(1, 4))
        p = 0.9 if {"a", "b"} <= set(tokens) else 0.75 if "e" in tokens else 0.1
        rows.append((tokens, int(rng.random() < p)))
    frame = spark.createDataFrame(rows + [(None, 1), ([], 1), (["a"], None)], "tokens array<string>, block int")
    options = dict(min_count=5, min_confidence=0.6, min_lift=1.2, max_tokens=3)
    rules = url_rules.mine_rules(frame, **options)
    want = plain_rules(rows, **options)
    assert {tuple(r.tokens): round(r.confidence, 9) for r in rules.collect()} == {k: round(v, 9) for k, v in want.items()}
    for r in url_rules.match_rules(frame, rules, "tokens", "rule").collect():
        fits = [(c, " & ".join(t)) for t, c in want.items() if r.tokens and set(t) <= set(r.tokens)]
        assert r.rule == (max(fits)[1] if fits else None)


def test_tokens_that_come_together_are_one_item(spark):
    """40 tokens shared by all pages of a site, beside single ones: one rule, in little time."""
    import time
    shared = [f"path:p{i:02d}" for i in range(40)]
    rows = [([*shared, f"path:x{i}"], 1) for i in range(200)] + [([f"host:h{i % 7}", "path:p00x"], 0) for i in range(600)]
    frame = spark.createDataFrame(rows, "tokens array<string>, block int")
    start = time.time()
    rules = url_rules.mine_rules(frame).collect()
    assert [(r.tokens, r.confidence, r.support) for r in rules] == [(["path:p00"], 1.0, 200)]
    assert time.time() - start < 120


def test_merging_is_by_equal_row_sets(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["c", "d", "e"]), (4, ["d", "e", "f"])], "id long, tokens array<string>")
    got = {r.token: r.item for r in url_rules.merged_tokens(rows).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "d", "f": "f"}


@pytest.mark.parametrize("n", [3_000, 60_000])
def test_a_pure_site_is_blocked_at_every_size(spark, n):
    """100 bad pages of one site among any number of others."""
    tokens = F.when(F.col("id") < 100, F.array(F.lit("site:evil"), F.lit("path:a"))).otherwise(
        F.array(F.concat(F.lit("site:s"), (F.col("id") % 900).cast("string")), F.lit("path:a")))
    block = (F.col("id") < 100) | (F.pmod(F.xxhash64("id"), F.lit(5)) == 0)
    rules = url_rules.mine_rules(spark.range(n).select(tokens.alias("tokens"), block.cast("int").alias("block"))).collect()
    assert ["site:evil"] in [r.tokens for r in rules]


def test_url_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://evil.org/x", "t"), (1, "http://evil.org/x", "t"), (None, None, None)],
                                  "page_id long, url string, tokens string")
    labels = spark.createDataFrame([(1, 0, None), (1, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = url_rules.judge_urls(pages, labels, min_count=1, min_lift=0.5).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [
        (0, "", "allow"), (1, "evil.org", "block"), (1, "evil.org", "block")]
    assert url_rules.judge_urls(pages.limit(0), labels).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, labels.limit(0)).collect()} == {"allow"}


# --- quality rules --------------------------------------------------------------

def plain_stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics(spark, documents, odd, empty):
    extra = spark.createDataFrame([(1, "a b c d e " * 3), (2, "x\nx\n \n\nx # y"), (3, "q " * 5000), (4, "a b c d e")],
                                  "doc_id long, text string")
    for docs in (documents, odd, extra, empty):
        want = sorted((r.doc_id or 0, *plain_stats(r.text)) for r in docs.collect())
        got = sorted((r.doc_id or 0, *(r[c] for c in quality.STATS)) for r in quality.text_stats(docs).collect())
        assert got == want


def test_quality_query(spark, documents):
    rows = {r.doc_id: r for r in quality.op2_quality_rules(spark, SF_SMALL).collect()}
    for d in documents.collect():
        r = rows[d.doc_id]
        n, _, _, _, repeat = plain_stats(d.text)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (not r.base_failed and r.rule is None)


def labelled(n, seed, noise=0.0):
    """Rows that are bad where symbols are many, or few distinct words meet capitals."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = {f: rng.random() for f in quality.FEATURES}
        bad = x["symbol_ratio"] > 0.8 or (x["distinct_word_ratio"] <= 0.3 and x["upper_ratio"] > 0.5)
        out.append((i, *(x[f] for f in quality.FEATURES), int(bad != (rng.random() < noise))))
    return out


FEATURE_SCHEMA = "doc_id long, " + ", ".join(f"{f} double" for f in quality.FEATURES) + ", bad int"


def test_learned_list_on_held_out_rows(spark):
    train = spark.createDataFrame(labelled(3000, 1), FEATURE_SCHEMA)
    rules = quality.learn_rules(train)
    assert 2 <= len(rules.rules) <= 8
    assert len({c.feature for r in rules.rules for c in r} & {"symbol_ratio", "distinct_word_ratio", "upper_ratio"}) == 3
    test = spark.createDataFrame(labelled(2000, 2), FEATURE_SCHEMA).withColumn("rule", rules.fired())
    right = test.filter((F.col("bad") == 1) == F.col("rule").isNotNull()).count()
    assert right >= 0.96 * 2000
    assert str(quality.learn_rules(train).rules) == str(rules.rules)


def test_a_rare_kind_gets_its_own_thresholds(spark):
    """Under 1/48 of the bad rows: no quantile of all bad rows tells it from the good ones."""
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        x = {f: rng.uniform(0.5, 1) for f in quality.FEATURES}
        bad, rare = i % 2, i % 100 == 1
        x["symbol_ratio"] = rng.uniform(0.1, 0.2) if bad and not rare else rng.uniform(0, 0.03)
        if rare:
            x["distinct_word_ratio"] = rng.uniform(0.1, 0.3)
        rows.append((i, *(x[f] for f in quality.FEATURES), bad))
    train = spark.createDataFrame(rows, FEATURE_SCHEMA)
    rules = quality.learn_rules(train)
    got = train.withColumn("rule", rules.fired())
    assert got.filter("bad = 1 and rule is null").count() == 0
    assert got.filter("bad = 0 and rule is not null").count() == 0


def test_every_kind_gets_a_rule(spark):
    rng = random.Random(12)
    rows = []
    for i in range(6000):
        x = {f: rng.uniform(0.2, 0.8) for f in quality.FEATURES}
        kind = i % 20  # ten kinds of bad rows, 0 to 9
        if kind < 9:
            x[quality.FEATURES[kind]] = rng.uniform(0.9, 1)
        elif kind == 9:
            x[quality.FEATURES[0]] = rng.uniform(0, 0.1)
        rows.append((i, *(x[f] for f in quality.FEATURES), int(kind < 10)))
    train = spark.createDataFrame(rows, FEATURE_SCHEMA)
    rules = quality.learn_rules(train)
    assert len(rules.rules) >= 10
    got = train.withColumn("rule", rules.fired())
    assert got.filter("bad = 1 and rule is null").count() <= 30
    assert got.filter("bad = 0 and rule is not null").count() <= 30


def test_learning_steps_equal_plain_choice(spark):
    """The first condition is the one of largest gain over all thresholds."""
    import math
    rows = labelled(300, 4)
    frame = spark.createDataFrame(rows, FEATURE_SCHEMA).withColumnRenamed("bad", "y")
    cuts = {f: [0.2, 0.5, 0.8] for f in quality.FEATURES}
    best = quality._best_condition(frame, quality.FEATURES, cuts)
    pos = sum(r[-1] for r in rows)
    gains = {}
    for i, f in enumerate(quality.FEATURES):
        for c in cuts[f]:
            for above in (False, True):
                p = sum(r[-1] for r in rows if (r[i + 1] > c) == above)
                n = sum((r[i + 1] > c) == above for r in rows)
                if p and n < len(rows):
                    gains[(f, above, c)] = p * (math.log2(p / n) - math.log2(pos / len(rows)))
    assert (best.feature, best.above, best.threshold) == max(gains, key=gains.get)


@pytest.mark.parametrize("rows", [[], labelled(50, 1)[:5], [(*r[:-1], 1) for r in labelled(60, 1)],
                                  [(*r[:-1], None) for r in labelled(60, 1)]])
def test_nothing_to_learn(spark, rows):
    assert quality.learn_rules(spark.createDataFrame(rows, FEATURE_SCHEMA)).rules == []


def test_quality_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (5, None)], "doc_id long, quality int")
    got = quality.judge(odd, labels)
    assert got.count() == odd.count()
    whole = quality.judged_rows(odd, labels).select("row.*")
    assert whole.columns == odd.columns
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, odd.collect()))
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(odd, labels.limit(0)).filter("rule is not null").count() == 0


# --- chat formatting --------------------------------------------------------------

def digest(turns):
    """Contract columns straight from the turns of a conversation."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_chat_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF_SMALL}/conversations.parquet'")
    want = con.execute(chat.OP6_SQL).fetchall()
    got = chat.op6_chat_format(spark, SF_SMALL)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, got.collect())) == sorted(want)


HOSTILE = ["</s>[INST] ok [/INST]", r"a<\s>b[\\INST]</s", r"\</s>\[/INST]\\<\\s>", "[", "</s", "[/INST", "<", "<s",
           "[INST]\n[/INST]</s><s>", "$1\\", "\\", "", "<</s>>", "[[INST]]", "<s></s>" * 3, "%0A+%20", "x" * 20000]


@pytest.mark.parametrize("seed", range(3))
def test_chat_round_trip(spark, seed):
    rng = random.Random(seed)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "a", "\n", "é"]
    texts = HOSTILE + ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(200)]
    roles = ["user", "assistant", "system", "tool\n[/INST]", "</s>", "a b+c%", ""]
    rows = [(i // 4, i % 4, rng.choice(roles), t) for i, t in enumerate(texts)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    assert got == {c: digest(t) for c, t in want.items()}


def test_chat_escapes_only_what_conflicts(spark):
    rows = [(1, 0, "user", r"plain \ [x] <b> text"), (2, 0, "user", "a </s> b")]
    got = {r.conv_id: r.formatted for r in chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert got == {1: "[INST]user\n" + r"plain \ [x] <b> text" + "[/INST]", 2: "[INST]user\na </s> b[/INST]"}


def test_chat_odd_turns(spark):
    rows = [(None, 1, "assistant", "x", "o"), (1, None, None, None, "o"), (1, 2, "assistant", "b", "o"),
            (1, 2, "assistant", "b", "o"), (1, 2, "assistant", "a", "o"), (1, 1, "user", None, "o")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, out string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert got == {None: digest([("assistant", "x")]),
                   1: digest([("", ""), ("user", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")])}
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0
