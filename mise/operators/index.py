"""Postings, collection statistics and scores over several fields at once.

An index row is one term of one field entry: ``(id, field, pos, term, tf, dl)``.  A field is

* analysed text (``text_field``), one entry per document;
* exact values (``keyword_field``): the whole value is the term, of an array each element;
* nested entries (``nested_field``): one entry per element of an array of structs, analysed or exact.

All fields of a document are cut into entries in one projection, so the texts are read once whatever
the number of fields.  Every entry also has a row with the empty term, which carries its length: the
statistics of a field (entries, summed length) are aggregated from these.

``StoredIndex`` keeps tables that are added to batch by batch: postings by (batch, field, term bucket),
and per batch, field and term the mergeable document frequencies and the deletion neighbourhoods, and per
batch and field the entry counts and summed lengths.  Queries add the batches' figures up and read no text:
of the postings only the buckets of their terms.  Postings and neighbourhoods, of which there are many more
than documents and terms, are written by the tasks that make them and never shuffled.  ``DocumentIndex`` answers the same questions from the documents, read once.

``field_scores`` scores all fields in one job.  BM25 is that of :mod:`mise.operators.scoring`; exact
values have no length norm, as in the search engine.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.analysis import Analyzer, english, ingredient_analyzer, stem_of, unstemmed
from ..session import cut_lineage
from . import fuzzy as FZ

POSTINGS = "id long, term string, tf long, dl int, pos int, batch string, field string, bucket int"
TERMS = "term string, df long, cf long, batch string, field string, bucket int"
STATS = "field string, entries long, total long, batch string"
NEIGHBOURHOODS = "term string, variants array<string>, batch string, field string, bucket int"
#: The bucket of the rows that carry lengths; terms have buckets from 0.
LENGTHS_BUCKET = -1


@dataclass(frozen=True)
class Field:
    name: str
    column: str
    analyzer: Analyzer | None = english   # None: exact values
    entry: str | None = None              # field of the structs of an array column

    def tokens(self, value: Column, many: bool = False) -> Column:
        if self.analyzer is not None:
            return F.coalesce(unstemmed(self.analyzer)(value), _no_terms())
        values = value if many else F.array(value)
        return F.filter(F.coalesce(values.cast("array<string>"), _no_terms()), lambda t: t.isNotNull())


def text_field(name: str, analyzer: Analyzer = english) -> Field:
    return Field(name, name, analyzer)


def keyword_field(name: str, column: str | None = None) -> Field:
    return Field(name, column or name, None)


def nested_field(path: str, entry: str, analyzer: Analyzer | None = ingredient_analyzer, name: str | None = None) -> Field:
    return Field(name or f"{path}.{entry}", path, analyzer, entry)


def _no_terms() -> Column:
    return F.array().cast("array<string>")


# -------------------------------------------------------------------------------------- rows
def entries(docs: DataFrame, fields: Sequence[Field], key: str = "id") -> DataFrame:
    """(id, field, pos, dl, tokens): the entries of all fields, not stemmed."""
    kinds = dict(docs.dtypes)

    def cut(f: Field) -> Column:
        def one(tokens: Column, pos: Column) -> Column:
            return F.struct(F.lit(f.name).alias("field"), pos.cast("int").alias("pos"), tokens.alias("tokens"))

        if f.entry is None:
            return F.array(one(f.tokens(F.col(f.column), kinds[f.column].startswith("array")), F.lit(0)))
        return F.coalesce(F.transform(f.column, lambda e, i: one(f.tokens(e[f.entry]), i)),
                          F.array().cast("array<struct<field:string,pos:int,tokens:array<string>>>"))

    rows = docs.select(F.col(key).alias("id"), F.explode(F.concat(*[cut(f) for f in fields])).alias("e"))
    return rows.select("id", "e.field", "e.pos", F.size("e.tokens").alias("dl"), "e.tokens")


def index_rows(docs: DataFrame, fields: Sequence[Field], terms: DataFrame | None = None, key: str = "id",
               prefix_length: int | None = None) -> DataFrame:
    """(id, field, pos, dl, term, tf), and for each entry a row with the empty term and tf 0.  With ``terms`` (field, term)
    only those, or those that begin as they do, are counted: the others go before the shuffle."""
    rows = entries(docs, fields, key)
    rows = rows.select("id", "field", "pos", "dl", F.explode(F.concat(F.array(F.lit("")), "tokens")).alias("term"))
    if terms is not None:
        # Stemmers keep the first character: what begins as no term goes before it is stemmed.
        begins = terms.select("field", F.substring("term", 1, 1).alias("_p")).unionByName(
            _length_terms(docs.sparkSession, fields).withColumnRenamed("term", "_p")).distinct()
        rows = rows.withColumn("_p", F.substring("term", 1, 1)).join(begins, ["field", "_p"], "left_semi").drop("_p")
    rows = _stemmed(rows, fields)
    if terms is not None:
        kept = terms.select("field", "term").unionByName(_length_terms(docs.sparkSession, fields))
        if prefix_length is None:
            rows = rows.join(kept.distinct(), ["field", "term"], "left_semi")
        else:
            begins = kept.select("field", F.substring("term", 1, prefix_length).alias("_p")).distinct()
            rows = rows.withColumn("_p", F.substring("term", 1, prefix_length)).join(begins, ["field", "_p"], "left_semi").drop("_p")
    return rows.groupBy("id", "field", "pos", "dl", "term").agg(F.sum(F.when(F.col("term") != "", 1).otherwise(0)).alias("tf"))


def _stemmed(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Terms of stemmed fields as their analyser stems them: row by row, in generated code."""
    by_rows: dict = {}
    stem = None
    for f in fields:
        own = stem_of(f.analyzer) if f.analyzer is not None else None
        if own is None:
            continue
        if getattr(f.analyzer, "stem_rows", None):
            by_rows.setdefault(f.analyzer.stem_rows, []).append(f.name)
            continue
        hit = F.col("field") == f.name
        stem = F.when(hit, own(F.col("term"))) if stem is None else stem.when(hit, own(F.col("term")))
    if stem is not None:
        rows = rows.withColumn("term", stem.otherwise(F.col("term")))
    for stem_rows, names in by_rows.items():
        rows = stem_rows(rows.withColumn("_stem", F.col("term")), "_stem")
        rows = rows.withColumn("term", F.when(F.col("field").isin(names), F.col("_stem")).otherwise(F.col("term"))).drop("_stem")
    return rows


def _length_terms(spark: SparkSession, fields: Sequence[Field]) -> DataFrame:
    names = F.explode(F.array(*[F.lit(f.name) for f in fields])).alias("field")
    return spark.range(1).select(names, F.lit("").alias("term"))


def _frequencies(rows: DataFrame, *by: str) -> DataFrame:
    return rows.where("term != ''").groupBy("field", *by, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _statistics(rows: DataFrame) -> DataFrame:
    return rows.where("term = '' AND dl > 0").groupBy("field").agg(F.count(F.lit(1)).alias("entries"), F.sum("dl").alias("total"))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


# ------------------------------------------------------------------------------------- sources
@dataclass(frozen=True)
class Found:
    """What an index answers for some terms: postings (id, field, pos, term, tf, dl), frequencies (field, term, df, cf)
    and statistics (field, entries, total)."""

    postings: DataFrame
    frequencies: DataFrame
    statistics: DataFrame


class DocumentIndex:
    """An index answered from the documents: they are cut once per query, and only the rows of its terms are kept."""

    def __init__(self, docs: DataFrame, fields: Sequence[Field], key: str = "id"):
        self.spark, self.docs, self.key = docs.sparkSession, docs, key
        self.fields = {f.name: f for f in fields}

    def _cut(self, terms: DataFrame, prefix_length: int | None = None) -> Found:
        # Cut once: three things are read from it.
        rows = cut_lineage(index_rows(self.docs, list(self.fields.values()), terms, self.key, prefix_length))
        return Found(rows.where("term != ''"), _frequencies(rows), _statistics(rows))

    def lookup(self, terms: DataFrame) -> Found:
        """The answers for ``terms`` (field, term)."""
        return self._cut(terms)

    def lookup_fuzzy(self, query: DataFrame, prefix_length: int = 2) -> tuple[DataFrame, Found]:
        """Expansions (field, boost, qterm, term, distance) of a query's terms, and the answers for them."""
        found = self._cut(query, prefix_length)
        return FZ.fuzzy_expansions(found.frequencies.select("field", "term"), query, prefix_length), found

    def document_terms(self, key) -> DataFrame:
        """(field, term, tf) of one document."""
        rows = index_rows(self.docs.where(F.col(self.key) == F.lit(key)), list(self.fields.values()), None, self.key)
        return rows.where("term != ''").groupBy("field", "term").agg(F.sum("tf").alias("tf"))


def _write(rows: DataFrame, path: str) -> None:
    """A folder per field and bucket, of few files: small parts are put together, large ones split."""
    _save(rows.hint("rebalance", "field", "bucket"), path)


def _save(rows: DataFrame, path: str) -> None:
    """A folder per field and bucket, where each task that has rows of them writes a file."""
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("field", "bucket").parquet(path)


class StoredIndex:
    """An index under ``path``, made by :func:`create_index` and filled by :meth:`add`."""

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[Field]):
        self.spark, self.path = spark, path
        self.fields = {f.name: f for f in fields}
        layout = spark.read.schema("buckets int, prefix_length int, fields string").json(f"{path}/layout").first()
        self.buckets, self.prefix_length = layout["buckets"], layout["prefix_length"]
        if sorted(json.loads(layout["fields"])) != sorted(self.fields):
            raise ValueError(f"the index has the fields {layout['fields']}")

    def batches(self) -> list[str]:
        """The completed batches, one row for each call of :meth:`add`."""
        return sorted(r["batch"] for r in self.spark.read.schema("batch string").json(f"{self.path}/batches").distinct().collect())

    def add(self, docs: DataFrame, batch: str, key: str = "id") -> None:
        """Adds documents that no other batch has.  A batch counts when its last file is written; one that failed, or is
        given again, is replaced."""
        rows = index_rows(docs, list(self.fields.values()), None, key)
        bucket = F.when(F.col("term") == "", F.lit(LENGTHS_BUCKET)).otherwise(term_bucket(F.col("term"), self.buckets))
        postings = f"{self.path}/postings/batch={batch}"
        # Rows are some times larger in a shuffle than in these files: they stay in the tasks that counted them.
        _save(rows.withColumn("bucket", bucket).sortWithinPartitions("field", "bucket", "term", "id"), postings)
        schema = "id long, pos int, dl int, term string, tf long, field string, bucket int"
        done = self.spark.read.schema(schema).parquet(postings)
        terms = f"{self.path}/terms/batch={batch}"
        _write(_frequencies(done.where(F.col("bucket") != LENGTHS_BUCKET), "bucket"), terms)
        _statistics(done.where(F.col("bucket") == LENGTHS_BUCKET)).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/stats/batch={batch}")
        # A term of a field has one row there: the postings need not be read again.
        distinct = self.spark.read.schema("term string, field string").parquet(terms)
        # Variants begin as their term does, so a term's neighbourhood is one row in the bucket of its prefix.
        placed = distinct.select("field", term_bucket(self._prefix("term"), self.buckets).alias("bucket"), "term")
        placed = placed.sortWithinPartitions("field", "bucket", "term")
        _save(placed.withColumn("variants", FZ.neighbourhood(F.col("term"), self.prefix_length)), f"{self.path}/neighbourhoods/batch={batch}")
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").json(f"{self.path}/batches")

    def _prefix(self, column: str) -> Column:
        return F.substring(column, 1, self.prefix_length)

    def _read(self, name: str, schema: str) -> DataFrame:
        # Batch names are a filter on folders.
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}").where(
            F.col("batch").isin(self.batches()))

    def _places(self, terms: DataFrame, column: str = "term") -> tuple[DataFrame, Column]:
        """The terms with their buckets, and the filter on folders that holds them: no more than there are buckets."""
        places = terms.select("field", column).distinct().withColumn("bucket", term_bucket(F.col(column), self.buckets))
        wanted = [tuple(r) for r in places.select("field", "bucket").distinct().collect()]
        named = F.lit(False)
        for field in sorted({f for f, _ in wanted}):
            named = named | ((F.col("field") == field) & F.col("bucket").isin(sorted({b for f, b in wanted if f == field})))
        return places, named

    def lookup(self, terms: DataFrame, small: bool = True) -> Found:
        """The answers for ``terms`` (field, term).  ``small``: they are a query's or a document's own, and sent to all tasks, so
        that postings are not shuffled to meet them."""
        places, named = self._places(terms)
        if small:
            places = F.broadcast(places)
        keys = ["field", "bucket", "term"]
        postings = self._read("postings", POSTINGS).where(named).join(places, keys, "left_semi")
        frequencies = self._read("terms", TERMS).where(named).join(places, keys, "left_semi")
        return Found(postings.drop("bucket", "batch"), _added(frequencies), self.statistics())

    def lookup_fuzzy(self, query: DataFrame, prefix_length: int = 2) -> tuple[DataFrame, Found]:
        """As that of :class:`DocumentIndex`, from the stored neighbourhoods."""
        if prefix_length != self.prefix_length:
            raise ValueError(f"the index was made for a prefix of {self.prefix_length} characters")
        q = query.select("field", "boost", F.col("term").alias("qterm"), FZ.auto_fuzziness(F.col("term")).alias("_limit"))
        q = q.withColumn("variant", F.explode(FZ.neighbourhood(F.col("qterm"), prefix_length, F.col("_limit"))))
        places, named = self._places(q.select("field", self._prefix("qterm").alias("_p")), "_p")
        stored = self._read("neighbourhoods", NEIGHBOURHOODS).where(named).withColumn("_p", self._prefix("term"))
        stored = stored.join(F.broadcast(places), ["field", "bucket", "_p"], "left_semi").select("field", "term", F.explode("variants").alias("variant"))
        pairs = stored.join(F.broadcast(q), ["field", "variant"]).select("field", "boost", "qterm", "term", "_limit").distinct()
        expansions = cut_lineage(FZ.decided(pairs))
        # Expansions grow with the vocabulary.
        return expansions, self.lookup(expansions, small=False)

    def statistics(self) -> DataFrame:
        return self._read("stats", STATS).groupBy("field").agg(F.sum("entries").alias("entries"), F.sum("total").alias("total"))

    def frequencies(self) -> DataFrame:
        """(field, term, df, cf) of the whole collection: the batches' figures added up."""
        return _added(self._read("terms", TERMS))

    def document_terms(self, key) -> DataFrame:
        rows = self._read("postings", POSTINGS).where((F.col("bucket") != LENGTHS_BUCKET) & (F.col("id") == F.lit(key)))
        return rows.groupBy("field", "term").agg(F.sum("tf").alias("tf"))


def _added(frequencies: DataFrame) -> DataFrame:
    """The batches' figures added up."""
    return frequencies.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


Index = DocumentIndex | StoredIndex


def create_index(spark: SparkSession, path: str, fields: Sequence[Field], buckets: int = 64, prefix_length: int = 2) -> StoredIndex:
    """An empty index; the number of term buckets, the fields and the prefix that fuzzy terms share are stored with it."""
    names = json.dumps([f.name for f in fields])
    spark.createDataFrame([(buckets, prefix_length, names)], "buckets int, prefix_length int, fields string").coalesce(1).write.mode("errorifexists").json(f"{path}/layout")
    return StoredIndex(spark, path, fields)


def document_fields(spec: Mapping[str, float], analyzers: Mapping[str, Analyzer] | None = None) -> list[Field]:
    """Analysed text fields for a boost table."""
    return [text_field(f, (analyzers or {}).get(f, english)) for f in spec]


# -------------------------------------------------------------------------------------- scores
def query_terms(index: Index, text: str, boosts: Mapping[str, float]) -> DataFrame:
    """(field, term, qtf, boost) of a query string, analysed as each field is; for exact fields the whole string is the term."""
    rows = []
    for name, boost in boosts.items():
        an = index.fields[name].analyzer
        rows.append(F.struct(F.lit(name).alias("field"), F.lit(float(boost)).alias("boost"),
                             (F.array(F.lit(text)) if an is None else an(F.lit(text))).alias("terms")))
    one = index.spark.range(1).select(F.explode(F.array(*rows)).alias("q"))
    one = one.select("q.field", "q.boost", F.explode("q.terms").alias("term"))
    return one.groupBy("field", "term", "boost").agg(F.count(F.lit(1)).alias("qtf"))


def figures_of(terms: DataFrame, found: Found) -> DataFrame:
    """``terms`` with what the collection says about them: df, n (entries of the field) and avgdl."""
    out = terms.join(found.frequencies.drop("cf"), ["field", "term"]).join(found.statistics, "field")
    return out.withColumn("n", F.col("entries").cast("double")).withColumn("avgdl", F.col("total") / F.col("entries")).drop("entries", "total")


def scored(index: Index, postings: DataFrame, figures: DataFrame, small: bool = True) -> DataFrame:
    """(id, field, pos, term, score): BM25 of each term (field, term, qtf, boost, df, n, avgdl) in each entry.  ``small``: the
    terms are a query's own, so they are sent to all tasks."""
    exact = [n for n, f in index.fields.items() if f.analyzer is None]
    found = postings.join(F.broadcast(figures) if small else figures, ["field", "term"])
    idf = F.log(F.lit(1.0) + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = F.lit(1 - lx.BM25_B) + F.lit(lx.BM25_B) * F.col("dl") / F.col("avgdl")
    norm = F.when(F.col("field").isin(exact), F.lit(1.0)).otherwise(length) if exact else length
    tf = F.col("tf").cast("double")
    score = F.col("qtf") * idf * (tf / (tf + F.lit(lx.BM25_K1) * norm)) * F.col("boost")
    return found.select("id", "field", "pos", "term", score.alias("score"))


def field_scores(index: Index, text: str, boosts: Mapping[str, float], score_mode: str = "sum") -> DataFrame:
    """(id, field, score) of every field with a boost; entries of a nested field combine by ``score_mode`` (sum, max, avg)."""
    terms = query_terms(index, text, boosts)
    answer = index.lookup(terms)
    found = scored(index, answer.postings, figures_of(terms, answer))
    if score_mode == "sum":
        return found.groupBy("id", "field").agg(F.sum("score").alias("score"))
    per_entry = found.groupBy("id", "field", "pos").agg(F.sum("score").alias("score"))
    return per_entry.groupBy("id", "field").agg({"max": F.max, "avg": F.avg}[score_mode]("score").alias("score"))
