import random

import pytest

from mise.llm import decontaminate as D
from tests.llm.conftest import EDGE_ROWS


def least(pattern, text):
    """Least edit distance to a substring, by the full table; and where the first one ends."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row), row.index(min(row))


def test_myers_is_the_least_distance():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert D.myers(p, t) == least(p, t)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        match rng.randrange(3):
            case 0:
                text[k] = "Q"
            case 1:
                text.insert(k, "Q")
            case 2:
                del text[k]
    return "".join(text)


@pytest.fixture(scope="module")
def planted(spark, make):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(10, 60))) for i in range(12)]
    rows = []
    for i, t in items:
        budget = int(len(t) * D.ERROR_RATE)
        for n in (0, 1, budget, budget + 8):
            rows.append((len(rows), f"{prose(20)} {edited(rng, t, n)} {prose(15)}"))
    rows += [(1000, prose(300)), (1001, items[0][1].upper().replace(" ", "\n")), (1002, items[1][1] + " " + items[2][1] + " " + items[1][1])]
    return rows, items


def test_all_pairs(spark, make, planted):
    rows, items = planted
    bench = spark.createDataFrame([*items, (50, None), (51, "tiny"), (53, " ?! "), (52, items[3][1])], "item_id long, text string")
    want = set()
    for d, t in rows:
        for i, item in [*items, (52, items[3][1])]:
            if least(D.folded(item), D.folded(t))[0] <= int(len(item) * D.ERROR_RATE):
                want.add((d, i))
    for block in (D.BLOCK_BYTES, 500):
        found = D.find_passages(make(rows), bench, block_bytes=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
        texts, by_id = dict(rows), dict(items)
        for r in found:
            passage = D.folded(texts[r["doc_id"]])[r["start"]:r["end"]]
            assert least(D.folded(by_id.get(r["item_id"], items[3][1])), passage)[0] == r["distance"]
    assert len([r for r in found if (r["doc_id"], r["item_id"]) == (1002, 1)]) == 2  # both passages


def test_filter(spark, clashing, planted):
    rows, items = planted
    rows = [(10_000 + d, t) for d, t in rows]  # EDGE_ROWS have the low ids
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing([*rows, *EDGE_ROWS])
    out = D.drop_contaminated(docs, bench)
    assert out.schema == docs.schema
    dirty = {r["doc_id"] for r in D.find_passages(docs, bench).collect()}
    left = [r["doc_id"] for r in out.collect()]
    assert sorted(map(str, left)) == sorted(str(d) for d, _ in [*rows, *EDGE_ROWS] if d not in dirty)
    assert left.count(4) == 2 and None in left


def test_empty(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_passages(make(EDGE_ROWS), none).count() == 0
    assert D.find_passages(make([]), spark.createDataFrame([(1, "a long enough item of a benchmark")], none.schema)).count() == 0
    assert D.drop_contaminated(make(EDGE_ROWS), none).count() == len(EDGE_ROWS)


def passages(spark, make, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = D.find_passages(make(list(enumerate(texts))), bench).orderBy("doc_id", "item_id", "start").collect()
    return [(r["doc_id"], r["item_id"], r["start"], r["end"], r["distance"]) for r in found]


def test_short_items_stand_for_themselves(spark, make):
    """Found word for word at word boundaries, in any case, and not inside words or with edits."""
    texts = ["so: what is 2 plus 2? I ask. WHAT IS 2\nPLUS 2?", "somewhat is 2 plus 2?", "what is 2 plus 3?", "what is 2 plus 2?what", "cat catalogue (cat) CAT", "a?b"]
    got = passages(spark, make, texts, [" What is 2 plus 2? ", "cat", "?", "", "   ", "capital of France"])
    assert got == [(0, 0, 4, 21, 0), (0, 0, 29, 46, 0), (3, 0, 0, 17, 0), (4, 1, 0, 3, 0), (4, 1, 15, 18, 0), (4, 1, 20, 23, 0)]


def test_every_passage_of_a_stretch(spark, make):
    """Passages back to back, exact and with edits, are a row each."""
    item = "the quick brown fox jumps over the lazy dog by the river bank"
    near = item.replace("brown", "brawn")
    texts = [item * 3, f"{item} {near} {item}", f"{near}{near}", f"{item[:-2]}{item}"]
    got = passages(spark, make, texts, [item])
    n = len(item)
    assert [g[2:] for g in got if g[0] == 0] == [(0, n, 0), (n, 2 * n, 0), (2 * n, 3 * n, 0)]
    assert [g[2:] for g in got if g[0] == 1] == [(0, n, 0), (n + 1, 2 * n + 1, 1), (2 * n + 2, 3 * n + 2, 0)]
    assert [g[4] for g in got if g[0] == 2] == [1, 1]
    assert [g[4] for g in got if g[0] == 3] == [2, 0]
