"""The operators bound to their whole tables, and their DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dart_minhash, decontaminate, filter_audit, license_scan, merkle, packing, quality, secret_scan, suffix_dedup, tokens, toxicity, unit_dedup, warc
from .common import own_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


SEQUENCE_TOKENS = 1024


# ----------------------------------------------------------------------------------- 1: licences
def _license_sql() -> str:
    known = license_scan.templates()
    bounds = [license_scan.size_bounds(len(t.bigrams), license_scan.LEAST_DICE) for t in known]
    values = ",\n".join(f"({i}, '{t.license_id}', {lo}, {hi}, {list(t.bigrams)!r})"
                        for i, (t, (lo, hi)) in enumerate(zip(known, bounds)))

    def units(kind: int, pattern: str) -> str:
        return f"""
  SELECT doc_row, {kind} AS kind, unnest(list_transform(range(1, len(p) + 1), lambda i: {{
           's': CAST(coalesce(list_sum(list_transform(p[1:i-1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(g[1:i-1], lambda x: length(x))), 0) AS BIGINT),
           't': p[i]}})) AS u
  FROM (SELECT doc_row, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS g FROM d)"""

    fewest, most = license_scan.run_words(known)
    words = "string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' ')".format
    listed = sorted({b for t in known for b in t.bigrams})
    bigrams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    paragraphs = units(1, r"\n[ \t\r]*\n")
    # Runs of paragraphs: sums of words tell how many lie between two of them.
    return f"""
WITH templates(place, license_id, low, high, bigrams) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS doc_row, doc_id, text AS t FROM documents WHERE text IS NOT NULL),
pw AS (SELECT doc_row, u.s AS s, u.s + length(u.t) AS e, {words("u.t")} AS w FROM ({paragraphs})),
pb AS (SELECT doc_row, s, e, len(w) AS n, {bigrams} AS b FROM pw WHERE w[1] <> ''),
p AS (SELECT doc_row, s, e, n, len(b) > 0 AND 100 * len(list_intersect(b, {listed!r})) >= {license_scan.LEAST_SHARE} * len(b) AS good,
             sum(n) OVER (PARTITION BY doc_row ORDER BY s) AS upto FROM pb),
r AS (SELECT doc_row, 3 AS kind, {{'s': x.s, 't': substr(d.t, x.s + 1, y.e - x.s)}} AS u FROM p x JOIN p y USING (doc_row) JOIN d USING (doc_row)
      WHERE x.good AND y.good AND x.s < y.s AND y.upto - x.upto + x.n BETWEEN {fewest} AND {most}),
u AS ({units(0, chr(92) + "n")} UNION ALL {paragraphs} UNION ALL SELECT doc_row, 2 AS kind, {{'s': CAST(0 AS BIGINT), 't': t}} AS u FROM d UNION ALL FROM r),
o AS (SELECT doc_row, u.s AS s, u.s + length(u.t) AS e, u.t AS t, kind,
             max(kind) OVER (PARTITION BY doc_row, u.s, u.s + length(u.t)) AS top FROM u
      QUALIFY row_number() OVER (PARTITION BY doc_row, u.s, u.s + length(u.t) ORDER BY kind) = 1),
w AS (SELECT doc_row, s, e, kind, top, {words("t")} AS w FROM o),
b AS (SELECT doc_row, s, e, kind, top, {bigrams} AS b FROM w WHERE len(w) > 1),
m AS (SELECT doc_row, s, e, kind, top, place, license_id, 2 * len(list_intersect(b, bigrams)) AS x, len(b) + len(bigrams) AS y
      FROM b JOIN templates ON len(b) BETWEEN low AND high),
f AS (SELECT * FROM m WHERE 100 * x >= {license_scan.LEAST_DICE} * y QUALIFY row_number() OVER (PARTITION BY doc_row, s, e ORDER BY x / y DESC, place) = 1)
SELECT doc_id, s AS "start", e AS "end", license_id, x / y AS dice FROM f JOIN d USING (doc_row)
WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM f g WHERE g.doc_row = f.doc_row AND g.top > 0 AND g.s < f.e AND f.s < g.e AND (
  g.x * f.y > f.x * g.y OR (g.x * f.y = f.x * g.y AND (g.kind < 3 OR (g.s, g.e) < (f.s, f.e)))))"""


@_query("op1_license_scan", _license_sql())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_spans(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------------------- 2: decontamination
@_query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------------------------ 3: secrets
def _span_sql(form: secret_scan.Form) -> str:
    found = f"regexp_extract_all(t, $${form.pattern}$$)"
    groups = f"regexp_extract_all(t, $${form.pattern}$$, {form.group})"
    return f"""
  SELECT doc_row, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
           's': CAST(list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS BIGINT),
           'm': f[i], 'g': g[i]}})) AS x
  FROM (SELECT doc_row, {found} AS f, {groups} AS g, string_split_regex(t, $${form.pattern}$$) AS b FROM d)"""


def _entropy_sql(cls: secret_scan.CharClass) -> str:
    w = cls.window
    runs = secret_scan.Form(cls.kind, cls.chars + "{" + str(w) + ",}", 0, 0, "")
    scaled = "[" + ", ".join(str(secret_scan.scaled(c)) for c in range(w + 1)) + "]"
    mixed = " AND ".join(f"regexp_matches(x.m, '{x}')" for x in _class_parts(cls))
    allowed = _allowed_sql()
    # The characters outside the allow-list's matches and their places, then one row for each window and character.
    return f"""
  SELECT doc_row, '{cls.kind}' AS kind, {secret_scan.KINDS.index(cls.kind)} AS k, min(s) AS s, max(e) AS e
  FROM (SELECT doc_row, run, i, s, e, sum({scaled}[n + 1]) AS total
        FROM (SELECT doc_row, run, i, s, e, c, count(*) AS n
              FROM (SELECT doc_row, run, i, run + spots[i + 1] AS s, run + spots[i + {w}] + 1 AS e, unnest(string_split(substr(m, i + 1, {w}), '')) AS c
                    FROM (SELECT doc_row, run, spots, m, unnest(range(0, length(m) - {w} + 1)) AS i
                          FROM (SELECT doc_row, run, array_to_string(p, '') AS m, flatten(list_transform(range(1, len(p) + 1), lambda j: range(
                                  CAST(coalesce(list_sum(list_transform(p[1:j-1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h[1:j-1], lambda x: length(x))), 0) AS BIGINT),
                                  CAST(coalesce(list_sum(list_transform(p[1:j], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h[1:j-1], lambda x: length(x))), 0) AS BIGINT)))) AS spots
                                FROM (SELECT doc_row, x.s AS run, string_split_regex(x.m, '{allowed}') AS p, regexp_extract_all(x.m, '{allowed}') AS h
                                      FROM ({_span_sql(runs)}) WHERE {mixed}))
                          WHERE length(m) >= {w}))
              GROUP BY doc_row, run, i, s, e, c)
        GROUP BY doc_row, run, i, s, e)
  WHERE total <= {secret_scan.most_scaled(cls)} GROUP BY doc_row, run"""


def _class_parts(cls: secret_scan.CharClass) -> list[str]:
    return [p.removesuffix(")") for p in cls.mixed.split("(?=.*")[1:]]


def _allowed_sql() -> str:
    words, repeated = secret_scan.ALLOWED.rsplit("|", 1)
    assert repeated == r"(.)\1{7}\1*"  # RE2 has no back references: runs of each character are listed
    runs = "|".join(c + "{8,}" for c in [*"0123456789abcdefghijklmnopqrstuvwxyz", r"\+", "/", "-", "_"])
    return f"{words}|{runs}"


def _base_sql(form: secret_scan.Form) -> str:
    return (f"SELECT doc_row, '{form.kind}' AS kind, {secret_scan.KINDS.index(form.kind)} AS k, x.s AS s, x.s + length(x.m) AS e "
            f"FROM ({_span_sql(form)}) WHERE length(x.g) >= {form.least}")


SECRETS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc_row, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({" UNION ALL ".join(_base_sql(f) for f in secret_scan.FORMS)}),
every AS (SELECT * FROM base UNION ALL {" UNION ALL ".join("SELECT * FROM (" + _entropy_sql(c) + ")" for c in secret_scan.CLASSES)}),
b AS (SELECT doc_row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM base GROUP BY doc_row),
a AS (SELECT doc_row, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM every GROUP BY doc_row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(a.spans, '') AS spans
FROM d LEFT JOIN b USING (doc_row) LEFT JOIN a USING (doc_row)"""


@_query("op3_secret_scan", SECRETS_SQL)
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------------------ 5: quality rules
_WORDS = r"'[^\x20\x09-\x0D]+'"
QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS doc_row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_WORDS}) AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS lines FROM d),
g AS (SELECT doc_row, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM (SELECT doc_row, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3)),
twice AS (SELECT doc_row, p FROM (SELECT doc_row, p, count(*) OVER (PARTITION BY doc_row, a, b, c) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_row, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_row, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY doc_row),
m AS (SELECT doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis
      FROM w LEFT JOIN r USING (doc_row)),
f AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > {quality.MAX_SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {quality.MAX_DUP_LINE_PERCENT} * n_lines
            OR NOT (word_chars BETWEEN {quality.MIN_MEAN_WORD} * n_words AND {quality.MAX_MEAN_WORD} * n_words)
            OR 100 * n_ellipsis > {quality.MAX_ELLIPSIS_PERCENT} * n_lines) AS kept
FROM f"""


@_query("op5_quality_rules", QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------------- 4, 10: tokens, packing
@_query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(), SEQUENCE_TOKENS)


@_query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), SEQUENCE_TOKENS)


# ------------------------------------------------------------------------------------ 6: toxicity
@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


# ------------------------------------------------------------------------------ 7: substring dedup
_NORM = "trim(regexp_replace(lower(unit), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
# Private-use characters mark the ends: of sentences, in place of the space after them, and after signs of scripts without spaces.
_CUT, _SIGN_CUT = 57344, 57345
UNITS_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d),
lo AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, t ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l),
p AS (SELECT doc_id, t, s, i, string_split(regexp_replace(line, '([.!?]) ', '\\1' || chr({_CUT}), 'g'), chr({_CUT})) AS parts FROM lo),
u AS (SELECT doc_id, t, s, i, unnest(parts) AS unit, unnest(range(1, len(parts) + 1)) AS j FROM p),
o AS (SELECT doc_id, t, i, j, unit, s + coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id, t, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM u),
g AS (SELECT doc_id, t, i, j, s, string_split(regexp_replace(unit, '([。！？｡])([^。！？｡」』”’）]|$)', '\\1' || chr({_SIGN_CUT}) || '\\2', 'g'), chr({_SIGN_CUT})) AS parts FROM o),
v AS (SELECT doc_id, t, i, j, s, unnest(parts) AS unit, unnest(range(1, len(parts) + 1)) AS k FROM g),
w AS (SELECT doc_id, t, i, unit, s + coalesce(sum(length(unit)) OVER (PARTITION BY doc_id, t, i, j ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM v),
n AS (SELECT doc_id, t, i, CAST(s AS BIGINT) AS s, CAST(s + length(unit) AS BIGINT) AS e, {_NORM} AS norm FROM w),
m AS (SELECT *, count(*) OVER (PARTITION BY doc_id, t, i) = 1 AS line, lag(norm) OVER (PARTITION BY doc_id, t ORDER BY s) AS before,
             lead(norm) OVER (PARTITION BY doc_id, t ORDER BY s) AS after,
             length(norm) - length(replace(norm, ' ', '')) + 1 < {unit_dedup.MIN_WORDS} AND length(norm) < {unit_dedup.CHANCE_CHARS} AS chance
      FROM n WHERE norm <> ''),
k AS (SELECT doc_id, t, s, e, '0' || norm AS key FROM m WHERE NOT chance UNION ALL SELECT doc_id, t, s, e, '1' || norm FROM m WHERE chance AND line
      UNION ALL SELECT doc_id, t, s, e, '2' || before || chr(10) || norm FROM m WHERE chance AND before IS NOT NULL
      UNION ALL SELECT doc_id, t, s, e, '3' || norm || chr(10) || after FROM m WHERE chance AND after IS NOT NULL),
r AS (SELECT doc_id, t, s, e, row_number() OVER x AS nth, first_value({{'d': doc_id, 't': t, 's': s}}) OVER x AS first
      FROM k WINDOW x AS (PARTITION BY key ORDER BY doc_id NULLS FIRST, t, s))
SELECT doc_id, s AS "start", e AS "end", min(first).d AS first_doc_id, min(first).s AS first_start FROM r WHERE nth > 1 GROUP BY doc_id, t, s, e"""


@_query("op7_substring_dedup", UNITS_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents"), "sentence", None).drop("text_hash")


# ------------------------------------------------------------------------------- 8: near duplicates
@_query("op8_dart_minhash")
def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


# ----------------------------------------------------------------------------- 9: suffix arrays
@_query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed_bytes(table(spark, sf_dir, "documents"))
    return found.withColumn("removed_from", F.when(F.col("n_removed") > 0, F.col("doc_id")))  # documents that lose bytes


# ------------------------------------------------------------------------- 11: filter interaction
_FLAGS = "SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id"
_LETTERS = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"
AUDIT_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_WORDS}) AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(w) < {filter_audit.MIN_WORDS} THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {filter_audit.MAX_UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '{filter_audit.SIGNS}') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN ({_FLAGS}) USING (doc_id) GROUP BY part, mask),
o AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM {_LETTERS} a(f, b), {_LETTERS} b(f, b), {_LETTERS} c(f, b), {_LETTERS} d(f, b), {_LETTERS} e(f, b)
      WHERE a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
      FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM o)),
x AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in filter_audit.FIGURES[:-1])},
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM x"""


@_query("op11_filter_audit", AUDIT_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")


# ------------------------------------------------------------------------------ 12: Merkle manifest
_MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text, by the table of its polynomial."""
    entries = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        entries.append(i)
    step = f"xor(c >> 8, (CAST({entries} AS BIGINT[]))[CAST((xor(c, b) & 255) + 1 AS INT)])"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), CAST(4294967295 AS BIGINT))"


def _merkle_levels_sql(name: str, key: str, levels: int) -> list[str]:
    """CTEs of the levels over ``name``0 (key, pos, h, cnt): nodes ``name``i and their runs ``name``i_runs."""
    out = []
    for i in range(levels):
        out.append(f"{name}{i}_runs AS (SELECT {key}, pos // 16 AS run, list(h ORDER BY pos) AS hs, any_value(cnt) AS cnt "
                   f"FROM {name}{i} GROUP BY {key}, pos // 16)")
        out.append(f"{name}{i + 1} AS (SELECT {key}, run AS pos, CASE WHEN cnt > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, "
                   f"(cnt + 15) // 16 AS cnt FROM {name}{i}_runs)")
    return out


def _merkle_path_sql(source: str, name: str, key: str, levels: int, result: str) -> list[str]:
    """CTEs that follow ``source`` (key, pos, folded, sibs) up the levels: folded and sibs grow by each."""
    out, at = [], source
    for i in range(levels):
        k = "x.pos % 16"
        left, right = f"array_to_string(r.hs[1:{k}], '')", f"array_to_string(r.hs[{k} + 2:], '')"
        out.append(f"{result}{i} AS (SELECT x.* EXCLUDE (pos, folded, sibs), x.pos // 16 AS pos, "
                   f"CASE WHEN r.cnt > 1 THEN sha256({left} || x.folded || {right}) ELSE x.folded END AS folded, "
                   f"CASE WHEN r.cnt > 1 THEN x.sibs || {left} || {right} ELSE x.sibs END AS sibs "
                   f"FROM {at} x JOIN {name}{i}_runs r ON x.{key} IS NOT DISTINCT FROM r.{key} AND x.pos // 16 = r.run)")
        at = f"{result}{i}"
    return out


def _manifest_sql(leaf_levels: int = 6, root_levels: int = 4) -> str:
    """Levels are written out: enough for 16 ** leaf_levels rows of a source and 16 ** root_levels sources."""
    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    leaf = "sha256(" + " || ".join(field(f) for f in _MANIFEST_FIELDS) + ")"
    changed = "sha256(" + " || ".join(field(f if f != "text" else f"translate(text, '{upper}', '{lower}')") for f in _MANIFEST_FIELDS) + ")"
    crc = _crc32_sql("CAST(doc_id AS VARCHAR)")
    ctes = [f"d AS (SELECT doc_id, source, {leaf} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {changed} ELSE {leaf} END AS told FROM documents)",
            "p AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS cnt FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))",
            "s0 AS (SELECT source, pos, leaf AS h, cnt FROM p)", *_merkle_levels_sql("s", "source", leaf_levels),
            f"subs AS (SELECT source, 0 AS one, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS cnt FROM s{leaf_levels})",
            "r0 AS (SELECT one, pos, subroot AS h, cnt FROM subs)", *_merkle_levels_sql("r", "one", root_levels),
            "a AS (SELECT doc_id, source, leaf, pos, told AS folded, '' AS sibs FROM p)", *_merkle_path_sql("a", "s", "source", leaf_levels, "sp"),
            f"b AS (SELECT y.doc_id, y.leaf, t.one, t.subroot, t.pos, y.folded, y.sibs FROM sp{leaf_levels - 1} y JOIN subs t ON y.source IS NOT DISTINCT FROM t.source)",
            *_merkle_path_sql("b", "r", "one", root_levels, "rp")]
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(sibs) AS proof_sha256, folded AS folded_root, folded = h AS verified "
            f"FROM rp{root_levels - 1}, r{root_levels}")


@_query("op12_merkle_manifest", _manifest_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    told = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in _MANIFEST_FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    built = merkle.manifest(table(spark, sf_dir, "documents"), _MANIFEST_FIELDS,
                            carry={"told": F.when(tampered, merkle.leaf_digest(told))})
    found = merkle.proofs(built).withColumn("folded_root", merkle.folded(F.coalesce("told", "leaf"), F.col("path")))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


# ---------------------------------------------------------------------------------------- 13: WARC
WARC_SQL = f"""
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS first FROM p
      WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, CASE WHEN n >= {warc.LEAST_BYTES} AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.LEAST_BYTES} AND nth > 1 THEN first END AS refers_to, true AS intact FROM r"""


@_query("op13_warc", WARC_SQL)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = own_folder(spark, "warc")
    index = warc.write_bundles(warc.archive_records(table(spark, sf_dir, "pages")), folder)
    return warc.read_bundles(warc.bundles(index), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
