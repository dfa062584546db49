import re

import pytest

from mise.llm import unit_dedup as U
from tests.llm.conftest import EDGE_ROWS

LONG = "this line holds more than six words"
ROWS = [(1, f"{LONG}.\nunique beginning of the first document here\n{LONG.upper()}!"), (2, f"short\n {LONG} \nshort"), (3, LONG), (3, LONG),
        (4, f"in front {LONG}. This sentence is said by two documents. the end é"), (5, "Nothing new here at all today. this SENTENCE is said by two documents."),
        (6, "one two three four five\none two three four five"), (None, LONG + " !")]


def brute(rows, unit, least=U.MIN_WORDS):
    units = set()
    for d, t in rows:
        at = 0
        for line in (t or "").split("\n"):
            parts, start = ([line], at)
            if unit == "sentence":
                parts = re.split(r"(?<=[.!?])\x20", line)
            for p in parts:
                norm = re.sub(r"[\W_]+", " ", p.lower()).strip()
                if len(norm.split()) >= least:
                    units.add((norm, d is not None, d or 0, start, start + len(p), d))
                start += len(p) + 1
            at += len(line) + 1
    first, out = {}, []
    for u in sorted(units):
        k = first.setdefault(u[0], u)
        if k is not u:
            out.append((u[5], u[3], u[4], k[5], k[3]))
    return sorted(map(str, out))


@pytest.mark.parametrize("unit", ["line", "sentence"])
@pytest.mark.parametrize("rows", [ROWS, EDGE_ROWS, [], [(i, f"{LONG}\nown line number {i} of this very document") for i in range(300)]])
def test_against_grouping(clashing, unit, rows):
    found = U.repeated_units(clashing(rows), unit).drop("text_hash")
    got = [tuple(r) for r in found.collect()]
    assert sorted({str(r) for r in got}) == brute(rows, unit)


def test_cleaning_keeps_offsets(make, clashing):
    docs = clashing([*ROWS, *EDGE_ROWS])
    out = U.remove_repeated_units(docs, "line")
    assert out.columns == [*docs.columns, "removed_spans"] and out.count() == docs.count()
    for r in U.remove_repeated_units(make(ROWS[:3] + ROWS[4:]), "line").collect():
        text = dict(ROWS)[r["doc_id"]]
        kept, at = "", 0
        for x in r["removed_spans"]:
            kept, at = kept + text[at:x["s"]], x["e"]
        assert r["text"] == kept + text[at:]
    with pytest.raises(ValueError):
        U.remove_repeated_units(out)


def test_same_id_with_other_texts(make):
    rows = [(1, LONG), (1, LONG + " and more of it")]
    assert U.repeated_units(make(rows)).count() == 0
    assert U.repeated_units(make([(1, LONG), (1, "x\n" + LONG)])).count() == 1


def test_short_units(make):
    """Short lines, short sentences in repeated runs and texts without spaces go; a chance repeat inside a line stays."""
    run = f"{LONG}. Not so. And another sentence of more than six words here."
    han = "这是第一句很长的话，它在两个文档里都出现。短句。这是第二句同样很长的话，也出现两次。"
    rows = [(1, f"Table of contents\nTo begin with this: {run} Yes. Ends one way."), (2, f"Table of contents\n{run} Yes. Ends another way."),
            (3, "I said yes. Not so. He left us."), (4, han), (5, "前言。" + han), (6, "No. No. No.")]
    removed = {d: [] for d, _ in rows}
    for r in U.repeated_units(make(rows), "sentence", None).orderBy("doc_id", "start").collect():
        text, first = dict(rows)[r["doc_id"]], dict(rows)[r["first_doc_id"]]
        unit = text[r["start"]:r["end"]]
        assert re.sub(r"\W", "", first[r["first_start"]:].lower()).startswith(re.sub(r"\W", "", unit.lower()))
        removed[r["doc_id"]].append(unit)
    assert removed[1] == removed[3] == removed[4] == [] and removed[6] == ["No.", "No."]
    assert removed[2] == ["Table of contents", "Not so.", "And another sentence of more than six words here.", "Yes."]
    assert removed[5] == ["这是第一句很长的话，它在两个文档里都出现。", "短句。", "这是第二句同样很长的话，也出现两次。"]


def test_short_units_of_edge_rows(clashing):
    found = U.repeated_units(clashing([*EDGE_ROWS, (9, "x")]), "sentence", None).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["first_doc_id"]) for r in found] == [(9, 0, 1, 5)]


def brute_all(rows):
    """Units of any length with their neighbours, grouped by plain strings."""
    keys = {}
    for d, t in {(d, t or "") for d, t in rows}:
        units, at = [], 0
        for line in t.split("\n"):
            found, start = [], at
            for part in re.split(r"(?<=[.!?])\x20", line):
                for u in re.split(U.SIGN_END, part):
                    norm = re.sub(r"[\W_]+", " ", u.lower()).strip()
                    if norm:
                        found.append([start, start + len(u), norm, False])
                    start += len(u)
                start += 1
            if len(found) == 1:
                found[0][3] = True
            units += found
            at += len(line) + 1
        for i, (s, e, norm, line) in enumerate(units):
            place = (d is not None, d or 0, s, e, d)
            if len(norm.split(" ")) >= U.MIN_WORDS or len(norm) >= U.CHANCE_CHARS:
                keys.setdefault((0, norm), []).append(place)
                continue
            if line:
                keys.setdefault((1, norm), []).append(place)
            if i:
                keys.setdefault((2, units[i - 1][2], norm), []).append(place)
            if i + 1 < len(units):
                keys.setdefault((3, norm, units[i + 1][2]), []).append(place)
    removed = {}
    for places in keys.values():
        first, *others = sorted(places)
        for p in others:
            removed[p] = min(removed.get(p, first), first)
    return sorted(str((p[4], p[2], p[3], f[4], f[2])) for p, f in removed.items())


MIXED = [(1, "Yes. No. A short one. Yes. No.\nTable of contents\nYes."), (2, "Table of contents\nyes. no.\nA short one."), (3, "第一句。短！第二句很长很长的一句话也在这里出现。短！"),
         (4, "短！第二句很长很长的一句话也在这里出现。”短！"), (5, "a b c d e f. g. a b c d e f. g. h"), (None, "Yes. No."), (6, "... !!! ?\n\n.  ."), (7, "A short one.\nYes")]


@pytest.mark.parametrize("rows", [ROWS, EDGE_ROWS, MIXED, [*MIXED, *EDGE_ROWS], []])
def test_any_length_against_grouping(clashing, rows):
    found = U.repeated_units(clashing(rows), "sentence", None).drop("text_hash")
    assert sorted({str(tuple(r)) for r in found.collect()}) == brute_all(rows)
