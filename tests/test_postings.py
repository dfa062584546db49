"""S2 persisted postings: reading back a bucket-pruned index gives the on-the-fly BM25 scores."""

from pyspark.sql import functions as F

from mise.functions.analysis import english
from mise.operators import scoring as SC


def test_persisted_postings_match_on_the_fly(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "Chocolate chip cookies with chocolate"), (2, "Oat cookies"), (3, "Spicy thai curry with rice"),
         (4, "Rice pudding with cinnamon"), (5, "Chocolate cake")], "id long, description string")
    fields = {"description": english}
    SC.write_postings(SC.build_postings(docs, fields), SC.field_lengths(docs, fields), str(tmp_path / "idx"), 16)
    terms = SC.query_terms(spark, "chocolate rice", english)
    stored = SC.read_postings(spark, str(tmp_path / "idx"), terms, "description")
    got = SC.bm25(stored, SC.read_lengths(spark, str(tmp_path / "idx")), terms, "description")
    want = SC.bm25_frame(docs, "chocolate rice", "description")
    g = {r.id: round(r.score, 9) for r in got.collect()}
    w = {r.id: round(r.score, 9) for r in want.collect()}
    assert g == w and set(g) == {1, 3, 4, 5}
    assert stored.select(F.countDistinct("term")).first()[0] == 2


def test_search_operators_on_persisted_index(spark, tmp_path):
    from mise.operators import search as S
    docs = spark.createDataFrame(
        [(1, "Chocolate cookies", "Crispy chocolate cookies"), (2, "Oat cookies", "Oats and raisins"),
         (3, "Thai curry", "Spicy curry with rice"), (4, "Rice pudding", "Creamy rice")],
        "id long, title string, description string")
    fields = {"title": english, "description": english}
    idx = str(tmp_path / "idx2")
    SC.write_postings(SC.build_postings(docs, fields), SC.field_lengths(docs, fields), idx, 16)
    a = S.multi_match(docs, "rice cookies", {"title": 2.0, "description": 1.0}, 0.3).collect()
    b = S.multi_match(docs, "rice cookies", {"title": 2.0, "description": 1.0}, 0.3, index=idx).collect()
    assert [(r.id, round(r.score, 9)) for r in a] == [(r.id, round(r.score, 9)) for r in b]
    c = S.match(docs, "description", "rice", index=idx).collect()
    assert [r.id for r in c] == [4, 3]
