"""Work per row that must not grow: texts searched where a pattern can match, lines and records parsed once, postings that stay
where they are."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from mise.functions import lexicon as lx
from mise.functions.text import first_match, split_sections_col
from mise.operators import index as IX
from mise.operators import search as S
from mise.plans import queries_search as Q

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_needed_words_lose_no_match(spark):
    texts = ["serves 4", "servings: 2-3", "yields 6", "makes 12 people", "for 3 people", "feeds 9 servings", "5 portions", "prep time: 5 min",
             "preparation: 1 hour", "takes 10 minutes to prep", "cook: 2 hrs", "cook time: 5 min", "cooking time: 5 min", "bake for 7 min", "cook for 1-2 hours",
             "total: 5 min", "total cooking time: 3 hr", "all together: 9 min", "difficulty: easy", "skill: advanced", "level hard", "so medium it is",
             "really easy", "veryeasy", "nothing", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in lx.NEEDED:
        plain = F.nullif(F.regexp_extract("t", p, 1), F.lit(""))
        assert df.where(~first_match("t", [p]).eqNullSafe(plain)).count() == 0, p
    seen = df.select(*[F.count(first_match("t", [p])) for p in lx.NEEDED]).first()
    assert all(seen)
    assert "contains" in optimized(df.select(first_match("t", lx.PREP_PATTERNS)).where("true")).lower()


def test_marks_are_dropped_before_the_text_is_cut(spark):
    text = "a note\n **In-gredients:** \nsalt\n\t_D*irections_\nstir\n##Method-ology\nmore"
    out = spark.createDataFrame([(text,)], "t string").select(split_sections_col("t").alias("s")).first()["s"]
    assert out["general"] == ["a note"] and out["ingredients"] == ["salt"] and out["instructions"] == ["stir", "more"]
    other = spark.createDataFrame([(text.replace("*", "~"),)], "t string").select(split_sections_col("t", marks=r"[~#\-_:]").alias("s")).first()["s"]
    assert other["ingredients"] == ["salt"] and other["instructions"] == ["stir", "more"]


def test_counts_parse_lines_once(spark):
    plan = optimized(E.queries()["order_post_counts"](spark, SF))
    top = plan[plan.index("Aggregate [dataset"):].split("\n")[0]
    assert "transform" not in top and "regexp" not in top


def test_records_are_parsed_once(spark):
    plan = optimized(E.queries()["coerce_json_records"](spark, SF)).lower().replace("_", "")
    assert plan.count("parsejson") == 1


def test_highlight_sums_no_offsets(spark):
    df = spark.createDataFrame([("The salts, the Salt!",), ("",), (None,)], "t string")
    out = df.select(S.highlight_match_col(F.col("t"), ["salt", "the"]).alias("h"))
    assert [r["h"] for r in out.collect()] == ["The <em>salts</em>, the <em>Salt</em>!", "", None]
    assert "aggregate(" not in optimized(out)


def test_lookup_sends_terms_to_the_postings(spark, tmp_path):
    fields = [IX.text_field("t")]
    index = IX.create_index(spark, str(tmp_path / "i"), fields, buckets=2)
    index.add(spark.createDataFrame([(1, "red salt"), (2, "salt salt")], "id long, t string"), "a")
    found = index.lookup(spark.createDataFrame([("t", "salt")], "field string, term string"))
    assert sorted((r["id"], r["tf"]) for r in found.postings.collect()) == [(1, 1), (2, 2)]
    plan = found.postings._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_documents_are_dealt_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(IX.StoredIndex, "add", lambda self, docs, batch, key="id": plans.append(
        IX.index_rows(docs, list(self.fields.values()), None, key)._jdf.queryExecution().sparkPlan().toString()
        + IX.index_rows(docs, list(self.fields.values()), None, key)._jdf.queryExecution().executedPlan().toString()))
    monkeypatch.setattr(Q, "_STORED", {})
    Q.stored_documents(spark, SF)
    assert len(plans) == 2 and all("ENSURE_REQUIREMENTS" not in p for p in plans)
