import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mise.llm import merkle as M
from mise.llm import queries
from tests.llm.conftest import EDGE_ROWS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def fold_up(nodes, fanout):
    """All levels of plain lists, the lone top last."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path_of(levels, i, fanout):
    path = []
    for level in levels[:-1]:
        run = i - i % fanout
        path.append(("".join(level[run:i]), "".join(level[i + 1:run + fanout])))
        i //= fanout
    return path


def brute(rows, fanout=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = fold_up([leaf(r) for r in groups[k]], fanout)
    top = fold_up([trees[k][-1][0] for k in keys], fanout)
    out = []
    for i, k in enumerate(keys):
        for j, r in enumerate(groups[k]):
            path = path_of(trees[k], j, fanout) + path_of(top, i, fanout)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], path, r))
    return out


def told_root(row, path):
    if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
        row = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
    node = leaf(row)
    for left, right in path:
        node = h(left, node, right)
    return node


def rows_of(sizes, prefix="s"):
    rows, at = [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            rows.append((at, None if k == 1 else f"{prefix}{'é' * (k % 3)}{k}", "en" if at % 3 else None, at * 7, f"Text {at} É"))
            at += 1
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fanout,stride,sizes", [(2, 2, [1, 2, 3, 4, 5, 8, 9, 16, 17, 33]), (2, 1, [7, 1, 13]), (3, 3, [28, 27, 1, 82]), (16, 2, [1, 16, 17, 256, 257, 600]),
                                                 (16, 2, [40])])
def test_paths_against_plain_lists(spark, fanout, stride, sizes):
    rows = rows_of(sizes)
    m = M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), FIELDS, fanout=fanout, stride=stride)
    got = {r["id"]: r for r in M.proofs(m).collect()}
    want = brute(rows, fanout)
    assert len(got) == len(rows)
    for doc_id, digest, subroot, root, path, row in want:
        r = got[doc_id]
        assert (r["leaf"], r["subroot"], r["root"], r["group"]) == (digest, subroot, root, row[1])
        assert [tuple(s) for s in r["path"]] == path
    assert [r["root"] for r in M.root(m).collect()] == [want[0][3]]
    assert {r["group"]: r["subroot"] for r in M.subroots(m).collect()} == {w[5][1]: w[2] for w in want}


def test_only_every_few_levels_are_stored(spark):
    m = M.manifest(spark.createDataFrame(rows_of([70]), SCHEMA), FIELDS, fanout=2, stride=3)
    # 70 leaves in 9 subtrees of 8, their 9 tops in 2, and these 2 in one: levels 0, 3 and 6 of 0 to 7.
    assert [t.count() for t in m.leaves.levels] == [9, 2, 1]
    assert [r["n"] for t in m.leaves.levels for r in t.select("n").distinct().collect()] == [70, 9, 2]


def test_query_against_plain_lists(spark, tmp_path):
    rows = rows_of([3, 20, 300]) + [(None, "s0", "en", 1, "No id"), (None, "s0", "en", 1, "No id"), (5, "", None, None, None), (5, "", None, None, ""),
                                    *[(d, "edge", "en", None, t) for d, t in EDGE_ROWS]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect())))
    want = []
    for doc_id, digest, subroot, root, path, row in brute(rows):
        folded = told_root(row, path)
        want.append(str((doc_id, digest, subroot, root, h(*[s for p in path for s in p]), folded, folded == root)))
    assert got == sorted(want)
    assert sum("False" in w for w in want) > 20


def test_sql_over_edge_rows(spark, tmp_path):
    import duckdb
    rows = rows_of([1, 15, 40]) + [(7, "", None, None, None), (8, "", "de", 0, "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.execute(queries.ORACLE["op12_merkle_manifest"]).fetchall()
    assert sorted(map(str, found)) == sorted(map(str, (tuple(r) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect())))


def test_empty_and_clashing(spark, clashing):
    m = M.manifest(spark.createDataFrame([], SCHEMA), FIELDS)
    assert M.proofs(m).count() == M.root(m).count() == M.subroots(m).count() == 0
    docs = clashing([(1, "a"), (2, None)]).withColumn("path", F.lit("x")).withColumn("digest", F.lit("y")).withColumn("grp", F.lit("z"))
    m = M.manifest(docs, ("doc_id", "text"), group_col="label")
    assert M.proofs(m).count() == 2 and M.root(m).count() == 1
    with pytest.raises(ValueError):
        M.manifest(docs, ("doc_id",), "label", carry={"digest": F.lit(1)})
    with pytest.raises(ValueError):
        M.manifest(docs, ("doc_id",), "label", fanout=1)
