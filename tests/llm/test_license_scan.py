from fractions import Fraction

import duckdb
import pandas as pd
import pytest

from mise.llm import license_scan as L
from mise.llm import queries
from mise.llm.license_texts import TEMPLATES
from tests.llm.conftest import EDGE_ROWS


def brute(text):
    """All units against all templates, without markers or size bounds."""
    import re
    text = text or ""
    units = {}
    for kind, pattern in enumerate(("\n", r"\n[\x20\t\r]*\n")):
        at = 0
        for m in [*re.finditer(pattern, text), None]:
            end = m.start() if m else len(text)
            units.setdefault((at, end), kind)
            at = m.end() if m else at
    units.setdefault((0, len(text)), 2)
    out, known = [], L.templates()
    listed = {b for t in known for b in t.bigrams}
    blocks, at = [], 0
    for m in [*re.finditer(r"\n[\x20\t\r]*\n", text), None]:
        end = m.start() if m else len(text)
        grams = bigrams(text[at:end])
        if L.plain_words(text[at:end]):
            blocks.append((at, end, grams and 100 * len(grams & listed) >= L.LEAST_SHARE * len(grams)))
        at = m.end() if m else at
    wide = {(a, b) for a, b, _ in blocks} | {(0, len(text))}
    for i, (a, _, x) in enumerate(blocks):
        for _, b, y in blocks[i + 1:]:
            if x and y and len(L.plain_words(text[a:b])) <= L.run_words(known)[1]:
                units.setdefault((a, b), 3)
    for (a, b), kind in units.items():
        grams = bigrams(text[a:b])
        scores = [(Fraction(2 * len(grams & set(t.bigrams)), len(grams) + len(t.bigrams)), -i) for i, t in enumerate(known)]
        d, i = max(scores)
        if 100 * d >= L.LEAST_DICE:
            out.append((a, b, known[-i].license_id, d, kind))
    rivals = [(a, b, d, kind) for a, b, _, d, kind in out if kind == 3 or (a, b) in wide]

    def best(a, b, d):
        return not any(x < b and a < y and (e > d or (e == d and (k < 3 or (x, y) < (a, b)))) for x, y, e, k in rivals)

    return sorted((a, b, name, round(float(d), 9)) for a, b, name, d, kind in out if kind < 3 or best(a, b, d))


def bigrams(text):
    w = L.plain_words(text)
    return {f"{x} {y}" for x, y in zip(w, w[1:])}


def test_against_all_pairs(make):
    mit = TEMPLATES[0][1]
    wrapped = "\n".join(mit[i:i + 70] for i in range(0, len(mit), 70))
    texts = ["code\nReleased under the MIT License.\nmore", mit, "intro\n\n" + wrapped + "\n\nend of it", mit.upper().replace(",", ""), "released MIT license",
             "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", "license software copyright", "é\n\n \nThis work is licensed under the GNU General Public License, version 3.",
             " ".join(mit.split()[:100])] + [t for _, t in TEMPLATES]
    rows = list(enumerate(texts))
    got = {}
    for r in L.license_spans(make(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["license_id"], round(r["dice"], 9)))
    for d, t in rows:
        assert sorted(got.get(d, [])) == brute(t), t


def test_markers_touch_more_than_a_match_may_miss():
    known = L.templates()
    words = set(L.marker_words(known, L.LEAST_DICE))
    for t in known:
        n = len(t.bigrams)
        low, high = L.size_bounds(n, L.LEAST_DICE)
        for size in range(low, high + 1):
            shared = -(-L.LEAST_DICE * (size + n) // 200)
            assert sum(bool(words & set(b.split())) for b in t.bigrams) > n - shared


def paragraphs(license_id, *starts):
    """The longest template of the licence, cut into paragraphs before the given words."""
    text = max((t for i, t in TEMPLATES if i == license_id), key=len)
    for start in starts:
        assert start in text
        text = text.replace(start, "\n\n" + start)
    return text


WORDS = "river stone lamp window garden copper seven morning letter travel quiet harbour".split()
FILL = "\n\n".join(" ".join(WORDS[(i * 7 + j * j) % 12] for j in range(40)) for i in range(12))
LAID_OUT = [("MIT", paragraphs("MIT", "The above copyright", "THE SOFTWARE IS")),
            ("BSD-3-Clause", paragraphs("BSD-3-Clause", "1. Redistributions", "2. Redistributions", "3. Neither", "THIS SOFTWARE IS")),
            ("Apache-2.0", paragraphs("Apache-2.0", "You may obtain", "http://www", "Unless required")),
            ("GPL-3.0", paragraphs("GPL-3.0", "This program is distributed"))]


def test_licences_of_several_paragraphs_in_longer_texts(make):
    rows = []
    for i, (_, text) in enumerate(LAID_OUT):
        rows += [(10 * i, f"{FILL}\n\n{text}\n\n{FILL}"), (10 * i + 1, f"{text}\n\nfoo\n\n{FILL}"), (10 * i + 2, f"{FILL}\n \n{text}")]
    rows += [(90, LAID_OUT[0][1] + "\n\n" + LAID_OUT[3][1]), (91, "\n\n".join([LAID_OUT[0][1]] * 3)), (92, LAID_OUT[2][1].replace("\n\n", "\n\n***\n\n")),
             (93, "Released under the MIT License.\n\nok\n\nLicensed under CC BY 4.0."), (94, "of the\n\n" * 60 + "any person")]
    got = {}
    for r in L.license_spans(make(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["license_id"], round(r["dice"], 9)))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    said = {}
    for d, license_id, *at, dice in con.execute(f'SELECT doc_id, license_id, "start", "end", dice FROM ({queries.ORACLE["op1_license_scan"]})').fetchall():
        said.setdefault(d, []).append((*at, license_id, round(dice, 9)))
    for d, t in rows:
        assert sorted(got.get(d, [])) == sorted(said.get(d, [])) == brute(t), d
    for i, (name, text) in enumerate(LAID_OUT):
        for k in range(3):
            at = rows[3 * i + k][1].index(text)
            assert (at, at + len(text), name, 1.0) in got[10 * i + k]


@pytest.mark.parametrize("rows", [[], EDGE_ROWS])
def test_edges(clashing, rows):
    assert L.license_spans(clashing(rows)).count() == 0
