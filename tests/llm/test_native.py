"""Exact dedup, chat formatting and the URL filter."""

import hashlib
import re

import pytest
from helpers import LONG, docs, table
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from walletscope.llm import chat, exact_dedup, queries, url_filter


def plain_classes(rows, keep=max):
    """Brute force: (id, text) to (keep_id, size, kept, sha)."""
    def norm(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    out = []
    for i, t in rows:
        same = [j for j, u in rows if norm(u) == norm(t)]
        ids = [j for j in same if j is not None]
        best = keep(ids) if ids else None
        out.append((i, best, len(same), i == best, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_classes_of_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    for keep, best in (("largest", max), ("smallest", min)):
        got = sorted(map(tuple, exact_dedup.classes(docs(spark), keep=keep).collect()), key=repr)
        assert got == plain_classes(rows, best)


def test_hash_collisions_are_told_apart(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    one = exact_dedup.classes(docs(spark), keep="largest", hashed=lambda t: F.lit(b"same"))
    assert sorted(map(tuple, one.collect()), key=repr) == plain_classes(rows)
    two = exact_dedup.drop_duplicates(docs(spark), keep="smallest", hashed=lambda t: F.substring(t, 1, 1).cast("binary"))
    assert sorted((r.doc_id for r in two.collect()), key=repr) == [1, 3, 5, 6, 7, None]


def test_drop_duplicates_keeps_columns_and_one_repeated_row(spark):
    clash = docs(spark).withColumn("kept", F.lit("mine")).withColumn("group_size", F.lit(9))
    left = exact_dedup.drop_duplicates(clash)
    assert left.columns == clash.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [1, 3, 5, 6, 7, None]
    assert left.filter("doc_id = 5").first().text == LONG


def test_dedup_of_nothing(spark):
    assert exact_dedup.classes(docs(spark, [])).count() == 0
    assert exact_dedup.drop_duplicates(docs(spark, [])).count() == 0


TURNS = "conv_id long, turn long, role string, text string, extra string"
CONTROL = "</s>[INST] ok [/INST]<|im_end|><|im_start|>"
CHATS = [
    (1, 0, "system", "be kind", "x"), (1, 1, "user", CONTROL, "x"), (1, 2, "assistant", r"<\/s> <\\/s> [\INST] \ <", "x"),
    (1, 3, "assistant", "more<", "x"), (1, 4, "user", "", "x"), (2, None, "user", None, "x"), (2, 0, None, "no role", "x"),
    (2, 0, None, "no role", "x"), (3, 5, "assistant", LONG, "x"), (3, 4, "assistant", "[", "x"),
    (None, 0, "user|>\n", "line\nline", "x"), (4, 1, "assistant", "tie b", "x"), (4, 1, "assistant", "tie a", "x")]


def test_chats_read_back(spark):
    shown = chat.format_chat(spark.createDataFrame(CHATS, TURNS))
    got = {r.conv_id: r for r in chat.read_chat(shown).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, row in got.items():
        mine = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x, _ in CHATS if c == conv))
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, r, x in mine]
        assert row.loss_text == "".join(x for _, r, x in mine if r == "assistant")


def test_adjacent_turns_share_a_block_and_texts_hold_no_control_string(spark):
    shown = {r.conv_id: r.formatted for r in chat.format_chat(spark.createDataFrame(CHATS, TURNS)).collect()}
    assert shown[1].count("<|im_start|>") == 4 and shown[1].count("<|im_next|>") == 1
    assert "</s>" not in shown[1] and "[INST]" not in shown[1]
    assert shown[3].count("<|im_start|>") == 1


def test_chat_of_nothing_and_bad_marks(spark):
    assert chat.format_chat(spark.createDataFrame([], TURNS)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(sep="a<b")


def plain_url(url):
    """Brute force: host, path, rule."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3:]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:cut])
        path = re.split("[?#]", rest[cut:])[0]
    best = None
    for r in url_filter.RULES:
        h, _, p = r.where.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(r.where) > len(best.where)):
            best = r
    return host, path, best


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/EN/1", "http://www.example.com/en/1?q=/de/", "a://b.net#/es/",
        "http://x.example.com/en/", "http://example.com", "http://example.com/", "x://y.net/es/z", "x://net/fr/", "x://anet/fr/",
        "x://a.b.net/fr/q://r.com/", "http://ünï.net/es/\nline", "http://com/" + "a" * 100_000]


def test_urls_by_rule(spark):
    pages = spark.createDataFrame([(i, u, "mine", 1.0) for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, _block double")
    model = url_filter.train(url_filter.labelled_urls(spark))
    judged = {r.page_id: r for r in url_filter.judge(pages, model).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = plain_url(url)
        got = judged[i]
        assert (got.host, got.path, got.rule) == (host, path, rule and rule.where)
        assert got.verdict == rule.verdict if rule else got.verdict in ("allow", "block")
    assert url_filter.judge(pages.limit(0), model).count() == 0


def test_url_model_on_held_out_words(spark):
    """Subjects that stand in no host of the training rows, in any form."""
    rows = url_filter.labelled_urls(spark).cache()
    held = F.pmod(F.xxhash64("word"), F.lit(4)) == 0
    model = url_filter.train(rows.filter(~held))
    words = [*url_filter.BLOCKED[1], *url_filter.ALLOWED[1]]
    seen = {(r.label, r.verdict): r["count"] for r in url_filter.judge(
        rows.filter(held & F.col("word").isin(words)), model, rules=()).groupBy("label", "verdict").count().collect()}
    caught, missed, wrong = seen[1, "block"], seen.get((1, "allow"), 0), seen.get((0, "block"), 0)
    assert caught + missed > 300 and caught >= 0.8 * (caught + missed) and wrong <= 0.02 * caught
    rows.unpersist()


def test_url_model_against_plain_odds(spark):
    """The verdict from n-grams, hashed places and weights, computed one url at a time."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    features, weights = url_filter.Features(), model.coefficients.toArray()
    hashing = HashingTF(numFeatures=features.width)
    made = url_filter.labelled_urls(spark).orderBy(F.xxhash64("url")).limit(60).collect()
    urls = [r.url for r in made] + URLS[:-1] + ["https://free-lottery.com/a", "x://ab/", "x://a/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    judged = {r.page_id: r.verdict for r in url_filter.judge(pages, model, rules=()).collect()}
    for i, url in enumerate(urls):
        host, path, _ = plain_url(url)
        grams = {f"{mark}{n}:{marked[at:at + n]}" for mark, text in (("h", host), ("p", path)) for marked in [f"^{text}$"]
                 for n in features.sizes for at in range(max(len(marked) - n + 1, 1))}
        odds = sum(weights[place] for place in {hashing.indexOf(g) for g in grams}) + model.intercept
        assert judged[i] == ("block" if odds > 0 else "allow"), url
    assert set(judged.values()) == {"block", "allow"}


def test_url_query_against_brute_force(spark):
    got = {r.page_id: r for r in queries.op4_url_filter(spark, "/root/testdata/sf0.001").collect()}
    pages = table(spark, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        host, path, rule = plain_url(p.url)
        g = got[p.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule and rule.where) and (not rule or g.verdict == rule.verdict)


@pytest.mark.parametrize("name,table_name", [("op4_url_filter", "pages"), ("op7_chat_format", "conversations"),
                                             ("op9_exact_dedup", "documents")])
def test_native_plans_hold_no_python(spark, name, table_name):
    text = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
