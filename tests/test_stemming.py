"""Porter2 stems of a fixed word list, by rows and for single values."""

from pyspark.sql import functions as F

from mise.functions.analysis import english_porter
from mise.functions.stemming import porter2, porter2_rows

# Words and their published stems.
STEMS = """
    consign consign, consigned consign, consigning consign, consignment consign, consist consist, consisted consist,
    consistency consist, consistent consist, consistently consist, consisting consist, consists consist, consolation consol,
    consolations consol, consolatory consolatori, console consol, consoled consol, consoles consol, consolidate consolid,
    consolidated consolid, consolidating consolid, consoling consol, consolingly consol, consols consol, consonant conson,
    consort consort, consorted consort, consorting consort, conspicuous conspicu, conspicuously conspicu, conspiracy conspiraci,
    conspirator conspir, conspirators conspir, conspire conspir, conspired conspir, conspiring conspir, constable constabl,
    constables constabl, constance constanc, constancy constanc, constant constant, knack knack, knackeries knackeri, knacks knack,
    knag knag, knave knave, knaves knave, knavish knavish, kneaded knead, kneading knead, knee knee, kneel kneel, kneeled kneel,
    kneeling kneel, kneels kneel, knees knee, knell knell, knelt knelt, knew knew, knick knick, knif knif, knife knife, knight knight,
    knightly knight, knights knight, knit knit, knits knit, knitted knit, knitting knit, knives knive, knob knob, knobs knob,
    knock knock, knocked knock, knocker knocker, knockers knocker, knocking knock, knocks knock, knopp knopp, knot knot, knots knot,
    cookies cooki, cookie cooki, berries berri, berry berri, ties tie, cries cri, gas gas, this this, gaps gap, kiwis kiwi,
    hopping hop, hoped hope, hoping hope, luxuriated luxuri, say say, by by, cry cri, generously generous, generate generat,
    communism communism, arsenal arsenal, skies sky, news news, inning inning, innings inning, proceeds proceed, youth youth,
    boyish boyish, sprayed spray, agreed agre, feed feed, relational relat, rationalization ration, hopefulness hope, abilities abil,
    sensibility sensibl, analogously analog, adoption adopt, roll roll, controlling control, glass glass, bus bus, eggs egg, dying die,
    beed beed, bed bed, shed shed, shredded shred, embed emb, bead bead, sing sing, yelly yelli, syzygy syzygi, happily happili,
    vietnamization vietnam, formative format, formalize formal, electrical electr, hopeful hope, goodness good, probate probat,
    rate rate, cease ceas, naïves naïv, x x, as as
"""


def test_word_list(spark):
    pairs = [tuple(p.split()) for p in STEMS.split(",")]
    df = spark.createDataFrame(pairs, "word string, stem string").withColumn("x", F.col("word"))
    assert [tuple(r) for r in porter2_rows(df, "x").where("x != stem").collect()] == []
    assert [tuple(r) for r in df.withColumn("x", porter2(F.col("word"))).where("x != stem").collect()] == []
    assert len(pairs) > 130


def test_other_words_and_columns(spark):
    words = ["", "a", "s", "é", "naïves", "2nd", "élèves", "y", "yy", "sss", "x" * 5000 + "ing"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [(None, 99)], "x string, i int")
    out = {r["i"]: r["x"] for r in porter2_rows(df, "x").select("i", "x").collect()}
    assert porter2_rows(df, "x").columns == df.columns
    assert out == {r["i"]: r["x"] for r in df.withColumn("x", porter2(F.col("x"))).collect()} and out[99] is None
    assert [out[i] for i in range(6)] == ["", "a", "s", "é", "naïv", "2nd"]


def test_analyser(spark):
    r = spark.createDataFrame([("The Cookies and the happiness of BERRIES",)], "t string").select(english_porter("t").alias("t")).first()
    assert r["t"] == ["cooki", "happi", "berri"]
