"""Term statistics and BM25 scoring.

``build_postings`` turns documents into ``(field, <key...>, term, tf, dl)`` rows: the tokens of a
document are exploded and counted by (document, term).  All tokens of a document sit in one
partition, so the partial aggregation before the shuffle already reduces them to one row per
distinct term: the shuffle carries postings, not tokens.  The document length travels on every
posting, so scoring needs no join back to the documents.

``bm25`` joins postings with the analysed query terms (a broadcast bounded by the query text),
takes document frequencies from the matching postings only, and reads the collection size and
average length as scalar subqueries (no cross join).  Scores follow Lucene's BM25 (k1 = 1.2,
b = 0.75, idf = ln(1 + (N - df + 0.5) / (df + 0.5)), no (k1 + 1) factor) with exact lengths
(Lucene quantises them), so rankings agree with the search engine and digits may not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.analysis import Analyzer, english, stem_of, unstemmed


def query_terms(spark: SparkSession, text: str, analyzer: Analyzer = english) -> DataFrame:
    """(term, qtf) of a query string, analysed by the same column expression as the documents."""
    one = spark.range(1).select(F.explode(analyzer(F.lit(text))).alias("term"))
    return one.groupBy("term").agg(F.count(F.lit(1)).alias("qtf"))


def field_tokens(docs: DataFrame, fields: Mapping[str, Analyzer], key: Sequence[str] = ("id",)) -> DataFrame:
    """(field, key..., dl, tokens) with one row per document and field."""
    parts = [docs.select(F.lit(f).alias("field"), *key, an(F.col(f)).alias("tokens")) for f, an in fields.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("dl", F.size("tokens"))


def build_postings(docs: DataFrame, fields: Mapping[str, Analyzer], key: Sequence[str] = ("id",),
                   terms: DataFrame | None = None) -> DataFrame:
    """(field, key..., term, tf, dl).

    Stemming (when the analyser stems) is applied after the explode, as a plain column
    expression.  With ``terms`` (analysed query terms) only those terms are aggregated: the
    semi join with the broadcast term list runs before the shuffle.
    """
    parts = []
    for f, an in fields.items():
        t = docs.select(F.lit(f).alias("field"), *key, unstemmed(an)(F.col(f)).alias("tokens"))
        t = t.select("field", *key, F.size("tokens").alias("dl"), F.explode("tokens").alias("term"))
        if stem_of(an) is not None:
            t = t.withColumn("term", stem_of(an)(F.col("term")))
        parts.append(t)
    tok = parts[0]
    for p in parts[1:]:
        tok = tok.unionByName(p)
    if terms is not None:
        # A query's own terms are few and Spark sends them to all; fuzzy expansions may be many.
        tok = tok.join(terms.select("term").distinct(), "term", "left_semi")
    return tok.groupBy("field", *key, "term", "dl").agg(F.count(F.lit(1)).alias("tf"))


def field_lengths(docs: DataFrame, fields: Mapping[str, Analyzer], key: Sequence[str] = ("id",)) -> DataFrame:
    """(field, key..., dl) per document (stemming does not change lengths, so it is skipped).
    Documents with an empty field keep dl = 0; statistics count only dl > 0, inside the
    aggregate, so the analyser is not pushed into a filter and evaluated twice."""
    return field_tokens(docs, {f: unstemmed(a) for f, a in fields.items()}, key).drop("tokens")


def field_stats(lengths: DataFrame, field: str) -> tuple[Column, Column]:
    """(documents with the field, average length) as scalar subqueries over one aggregate."""
    st = lengths.filter(F.col("field") == field).agg(
        F.count_if(F.col("dl") > 0).cast("double").alias("n"), F.avg(F.when(F.col("dl") > 0, F.col("dl"))).alias("a"))
    return st.select("n").scalar(), st.select("a").scalar()


def document_frequency(postings: DataFrame) -> DataFrame:
    """(field, term, df, cf): documents containing the term and total occurrences."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def bm25(postings: DataFrame, lengths: DataFrame, terms: DataFrame, field: str, key: Sequence[str] = ("id",),
         k1: float = lx.BM25_K1, b: float = lx.BM25_B, boost: float = 1.0, per_term: bool = False) -> DataFrame:
    """S3: (key..., score) for documents with at least one query term in ``field``
    (``per_term=True``: (key..., term, score))."""
    key = list(key)
    n_docs, avgdl = field_stats(lengths, field)
    p = postings.filter(F.col("field") == field).join(terms, "term")
    dfs = p.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    s = p.join(dfs, "term")
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    norm = tf / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / avgdl))
    by = [*key, "term"] if per_term else key
    return s.groupBy(*by).agg(F.sum(F.col("qtf") * idf * norm * F.lit(boost)).alias("score"))


def bm25_frame(docs: DataFrame, text: str, field: str, analyzer: Analyzer = english, key: Sequence[str] = ("id",),
               boost: float = 1.0) -> DataFrame:
    """BM25 of ``text`` on ``field``, computing postings from ``docs`` on the fly."""
    fields = {field: analyzer}
    terms = query_terms(docs.sparkSession, text, analyzer)
    return bm25(build_postings(docs, fields, key, terms), field_lengths(docs, fields, key), terms, field, key,
                boost=boost)


# ---------------------------------------------------------------------- persisted postings
def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(postings: DataFrame, lengths: DataFrame, path: str, buckets: int = 64) -> None:
    """Persist the index once: postings partitioned by field and term bucket, lengths by field, and
    the bucket count.  Queries then read only the buckets of their terms (see :func:`read_postings`)."""
    postings.sparkSession.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    (postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
             .write.mode("overwrite").partitionBy("field", "term_bucket").parquet(f"{path}/postings"))
    lengths.write.mode("overwrite").partitionBy("field").parquet(f"{path}/lengths")


def read_postings(spark: SparkSession, path: str, terms: DataFrame, field: str) -> DataFrame:
    """Postings of ``field`` for the query ``terms`` only.

    The bucket ids of the query terms (at most one per query term, computed by the same Spark
    hash) become a static partition filter, so only those directories are listed and read;
    the semi join with the broadcast terms then keeps the exact terms."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    q = terms.select("term").distinct().withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    wanted = sorted({r[0] for r in q.select("term_bucket").collect()})   # bounded by the query text
    post = (spark.read.parquet(f"{path}/postings")
                 .filter((F.col("field") == field) & F.col("term_bucket").isin(wanted)))
    return post.join(F.broadcast(q), ["term_bucket", "term"], "left_semi").drop("term_bucket")


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/lengths")
