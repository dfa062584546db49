import collections
import re

import pytest
from pyspark.sql import functions as F

from mise.llm import quality
from tests.llm.conftest import EDGE_ROWS


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = ["a b c a b c", "a a a a", "a b c d b c d e", "x\ny\nx\n \n \nx", "#*$ | <>", "one two", "a b c x a b c y b c x", "tab\tsep\x0bvt\rcr",
         "the cat the cat the cat sat", "no-break space is one word"]


def test_measures(make):
    rows = [*enumerate(TEXTS), *((100 + i, t) for i, (_, t) in enumerate(EDGE_ROWS))]
    got = {r["doc_id"]: r for r in quality.quality_report(make(rows)).collect()}
    for d, t in rows:
        r = got[d]
        assert brute(t) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]), t
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_hash_collisions_are_compared_as_strings(make, monkeypatch):
    monkeypatch.setattr(quality, "POSITION_BITS", 62)  # two bits of hash: every text collides
    rows = [(i, t * 3) for i, t in enumerate(TEXTS)] + [(50, " ".join(f"w{i % 37}" for i in range(200)))]
    got = {r["doc_id"]: r["n"] for r in make(rows).select("doc_id", quality.count_repeated_words(quality.text_words(F.col("text"))).alias("n")).collect()}
    assert got == {d: brute(t)[-1] for d, t in rows}


def test_order_never_changes_the_verdict(make):
    good = " ".join(f"word{i} and" for i in range(60))
    rows = [(1, good), (2, "few"), (3, good + " #$%" * 60), (4, "same line here\n" * 40), (5, " ".join(f"a{i}" for i in range(60)) + "\n..." * 9), (6, None)]
    rules = quality.default_rules(quality.whole_text("text"))
    docs = make(rows)
    kept = [{r[0] for r in docs.filter(quality.cascade(o)).select("doc_id").collect()} for o in (rules, rules[::-1], quality.rule_order(docs.select("text"), rules))]
    assert kept == [{1}] * 3
    report = {r["doc_id"] for r in quality.quality_report(docs).where("kept").collect()}
    assert report == {1}


def test_order_is_by_rejections_per_cost(make, monkeypatch):
    docs = make([(i, "few") for i in range(20)] + [(100, "a " * 60)])
    rules = quality.default_rules(quality.whole_text("text"))
    monkeypatch.setattr(quality, "rule_costs", lambda sample, rules: {r.name: 1.0 for r in rules})
    assert quality.rule_order(docs.select("text"), rules)[0].name in ("few_words", "word_length")
    monkeypatch.setattr(quality, "rule_costs", lambda sample, rules: {r.name: 1e9 if r.name == "few_words" else 1.0 for r in rules})
    assert quality.rule_order(docs.select("text"), rules)[0].name != "few_words"


@pytest.mark.parametrize("rows", [[], EDGE_ROWS])
def test_filter_carries_columns(clashing, rows):
    docs = clashing(rows)
    out = quality.keep_good(docs)
    assert out.schema == docs.schema
    assert out.count() == 0


def test_sample_is_no_prefix(spark, make):
    """What only later rows fail still moves its rule forward."""
    from mise.llm import quality as Q
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{good} {i}") for i in range(300)] + [(1000 + i, f"{good} {i} " + "$ # % & " * 20) for i in range(900)]
    order = Q.rule_order(make(rows).select("text"), Q.default_rules(Q.whole_text("text")))
    assert order[0].name == "symbols"
