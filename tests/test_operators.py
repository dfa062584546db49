"""Load, search and aggregation operators on small hand-worked fixtures (FIXTURES 8, 9)."""

import math

from pyspark.sql import functions as F

from mise import schemas as SCH
from mise.operators import aggregates as G
from mise.operators import load as L
from mise.operators import search as S

DOCS = [
    (1, ["chicken breast", "garlic", "rice"], "easy", 25, 10, "Asian", []),
    (2, ["ground beef", "onion"], "hard", 150, 90, "American", []),
    (3, ["pork", "garlic powder", "cheddar cheese"], "medium", 120, 50, None, []),
    (4, ["tofu", "rice"], "easy", 30, None, "Asian", ["vegan"]),
    (5, [], None, None, 5, "Italian", None),
]


def docs(spark):
    rows = [(i, f"dish {i}", [(n, None, None, None) for n in ings], d, t, s, s, c, tags)
            for i, ings, d, t, s, c, tags in DOCS]
    return spark.createDataFrame(rows, "id long, title string, ingredients array<struct<name:string,quantity:double,"
                                      "unit:string,notes:string>>, difficulty string, total_time_minutes int, "
                                      "post_score int, post_comments int, cuisine_type string, "
                                      "dietary_tags array<string>")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_predicates(spark):
    d = docs(spark)
    assert ids(d.filter(S.nested_wildcard("*GARLIC*"))) == [1, 3]
    assert ids(d.filter(S.ingredient_filter(("and", "garlic", ("or", "rice", "pork"))))) == [1, 3]
    assert ids(d.filter(S.ingredient_filter(("and", "rice", ("not", "chicken"))))) == [4]
    assert ids(d.filter(S.ingredient_filter(("not", "garlic")))) == [2, 4, 5]
    assert ids(d.filter(S.has_all(["garlic", "cheese"]))) == [3]
    assert ids(S.diet_search(d, cuisine="Asian", tags=["vegan"], exclude=["chicken", "beef", "cheese"])) == [4]


def test_semi_anti_form_equals_predicate_form(spark):
    d = docs(spark)
    m = G.mentions(d)
    for spec in (("and", "garlic", ("or", "rice", "pork")), ("not", "garlic"), ("or", "tofu", ("not", "rice"))):
        assert ids(S.ingredient_filter_sets(d.select("id"), m, spec)) == ids(d.filter(S.ingredient_filter(spec)))


def test_ordering_and_pages(spark):
    d = docs(spark)
    assert [r.id for r in S.quick(d, 30, by="score").collect()] == [1, 4]
    assert [r.id for r in S.quick(d, 30, by="time").collect()] == [1, 4]
    assert [r.id for r in S.project_dishes(d, ["medium", "hard"], 50, 120).collect()] == [2, 3]
    p = S.page_with_total(d, 3, 2).collect()
    assert [r.id for r in p] == [5] and p[0].total_hits == 5 and p[0].total_pages == 3
    rec = S.recommend(d, ["chicken breast", "garlic", "rice"]).collect()
    assert [(r.id, r.matched) for r in rec] == [(1, 3), (4, 1)]


def test_aggregations(spark):
    d = docs(spark)
    assert [tuple(r) for r in G.top_terms(d, "cuisine_type", 10).collect()] == [("Asian", 2), ("American", 1),
                                                                               ("Italian", 1)]
    assert [tuple(r) for r in G.top_ingredients(d, 1).collect()] == [("rice", 2)]
    f = {r.name: r for r in G.ingredient_frequency(d, 30).collect()}
    assert f["rice"].mentions == 2 and f["rice"].dishes == 2 and f["rice"].percent == 40.0
    hits = {(r.cuisine_type, r.id) for r in G.top_hits(d, "cuisine_type", "post_score", 1).collect()}
    assert hits == {("Asian", 1), ("American", 2), ("Italian", 5)}


def test_scores(spark):
    d = docs(spark)
    p = S.popularity(d, {"post_score": 0.5}, base=0.0).filter("id = 2").first().score
    assert math.isclose(p, math.log10(46))
    exp = S.fuzzy_expansions(spark.createDataFrame([(1, "spaghetti carbonara")], "id long, title string"),
                             "spagetti", "title").collect()
    assert [(r.term, r.distance) for r in exp] == [("spaghetti", 1)]


def _stage(spark, rows):
    return spark.createDataFrame(rows, "dataset string, entryNumber long, title string, ingredients array<struct<"
                                       "name:string,unit:string,amount:double,notes:string,order_index:int>>")


def _empty(spark):
    return L.Tables(spark.createDataFrame([], SCH.DISHES_TABLE), spark.createDataFrame([], SCH.DISH_INGREDIENTS_TABLE),
                    spark.createDataFrame([], SCH.INGREDIENTS_TABLE), spark.createDataFrame([], SCH.MEASUREMENTS_TABLE))


def test_load_dedupes_and_is_idempotent(spark):
    rows = [("d", 7, "Cake", [("sugar", "cup", 1.0, None, 0)]),
            ("d", 3, "Cake", [("flour", "cup", 2.0, None, 0)]),
            ("d", 4, "Soup", [(None, None, None, None, 0), ("salt", "tsp", None, None, 0)])]
    t1, out = L.load_stage(_stage(spark, rows), _empty(spark))
    status = {(r.entryNumber, r.status) for r in out.collect()}
    assert status == {(3, "inserted"), (4, "inserted"), (7, "existing")}
    j = t1.dish_ingredients.join(t1.ingredients.select(F.col("id").alias("ingredient_id"), "name"), "ingredient_id")
    got = sorted((r.name, r.measurement_id is None, r.order_index) for r in j.collect())
    assert got == [("Unknown Ingredient", True, 1), ("flour", False, 1), ("salt", False, 2)]
    t1 = L.Tables(*(x.cache() for x in
                    (t1.dishes, t1.dish_ingredients, t1.ingredients, t1.measurements)))
    t2, out2 = L.load_stage(_stage(spark, rows), t1)
    assert {r.status for r in out2.collect()} == {"existing"}
    assert (t2.dishes.count(), t2.dish_ingredients.count(), t2.ingredients.count(), t2.measurements.count()) == \
           (t1.dishes.count(), t1.dish_ingredients.count(), t1.ingredients.count(), t1.measurements.count())


def test_constraints_and_deletes(spark):
    r = spark.createDataFrame([(1, "x" * 501, "tough"), (2, "ok", "easy")], "id long, title string, difficulty string")
    v = L.check_constraints(r, [L.Rule("len", "max_length", "title", 500),
                                L.Rule("diff", "in_list", "difficulty", ["easy", "medium", "hard"])])
    assert sorted((x.rule, x.key) for x in v.collect()) == [("diff", "1"), ("len", "1")]
    j = spark.createDataFrame([(1, 10, 100), (1, 11, 101)], "dish_id long, ingredient_id long, measurement_id long")
    m = spark.createDataFrame([(100, "cup")], "id long, name string")
    _, j2 = L.delete_measurements(m, j, spark.createDataFrame([(100,)], "id long"))
    assert sorted((x.ingredient_id, x.measurement_id) for x in j2.collect()) == [(10, None), (11, 101)]


def test_dense_ids_follow_global_order(spark):
    from mise.operators.keys import dense_ids
    names = spark.createDataFrame([(f"n{i:05d}",) for i in range(3000)][::-1], "name string")
    got = {r.name: r.id for r in dense_ids(names.repartition(7), ["name"], start=10, partitions=5).collect()}
    assert got == {f"n{i:05d}": 11 + i for i in range(3000)}


def test_fuzzy_counts_a_transposition_as_one_edit(spark):
    d = spark.createDataFrame([(1, "Thai curry"), (2, "Spaghetti carbonara")], "id long, title string")
    exp = {(r.qterm, r.term): r.distance for r in S.fuzzy_expansions(d, "thia spahgetti", "title").collect()}
    assert exp == {("thia", "thai"): 1, ("spahgetti", "spaghetti"): 1}
    plain = S.fuzzy_expansions(d, "thia", "title", transpositions=False).collect()
    assert plain == []          # plain Levenshtein: 2 edits, over the AUTO limit of 1 for 4 letters


def _edits(a, b):
    """Edit distance with swaps of neighbours, between which characters may be edited as well."""
    last, d = {}, {(-1, -1): len(a) + len(b)}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = len(a) + len(b), i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = len(a) + len(b), j
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            p, q, same = last.get(b[j - 1], 0), match, a[i - 1] == b[j - 1]
            if same:
                match = j
            d[i, j] = min(d[i - 1, j - 1] + (not same), d[i, j - 1] + 1, d[i - 1, j] + 1,
                          d[p - 1, q - 1] + (i - p - 1) + 1 + (j - q - 1))
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def test_fuzzy_expansions_are_all_within_distance(spark):
    import random
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("xyz") for _ in range(rng.randint(3, 7))) for _ in range(250)})
    query = ["xyzxyz", "xyx", "zyxzy", "xzyyxz", "yxzzxyx"]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, title string")
    for prefix in (0, 2):
        got = {(r.qterm, r.term): r.distance for r in S.fuzzy_expansions(docs, " ".join(query), "title", prefix).collect()}
        limit = {q: 0 if len(q) <= 2 else 1 if len(q) <= 5 else 2 for q in query}
        want = {(q, w): _edits(q, w) for q in query for w in words if w[:prefix] == q[:prefix] and _edits(q, w) <= limit[q]}
        assert got == want
