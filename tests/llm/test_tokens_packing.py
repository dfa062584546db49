import zlib

import numpy as np
import pytest

from mise.llm import packing, tokens
from mise.llm.queries import vocabulary
from tests.llm.conftest import EDGE_ROWS

tokenizers = pytest.importorskip("tokenizers")
HARD = ["", " ", "  a  b", "a \n b\n\nc", " a ", "x<|endoftext|> b <|endoftext|>\n<|endoftext|>", "don't 's 've\n's it's", "\ta b c　d e\x1cf g", "é'll　x  ", "ǅ ²³ ½a ªº",
        "日本語 テキスト\n中文 x", "a\r\nb c\r", "\n", "\n\n", "a\n", "long" * 500 + " " + "x" * 60, "İstanbul ſ K", "emoji 👩‍👩‍👧 done", "\u0000 a\u0000b", "soft­hyphen x"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


def test_ids_are_the_librarys(library, spark):
    texts = HARD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    enc = tokens.Encoder(vocabulary())
    for batch in (texts, texts[::-1], *[[t] for t in HARD]):
        for t, ids in zip(batch, enc.ids(batch)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_bounded_memory_gives_the_same(monkeypatch, library):
    monkeypatch.setattr(tokens, "MOST_UNITS", 3)
    enc = tokens.Encoder(vocabulary())
    for _ in range(2):
        assert enc.lengths(HARD) == [len(library.encode(t, add_special_tokens=False).ids) for t in HARD]


def test_units_join_to_the_text():
    for t in HARD:
        assert "".join(tokens.text_units(t)) == t


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_are_used_whole(name, library):
    path = vocabulary(name)
    if name.endswith(".json"):
        own = tokenizers.Tokenizer.from_file(path)
        want = [own.encode(t, add_special_tokens=False).ids for t in HARD]
    else:
        spm = pytest.importorskip("sentencepiece")
        want = [spm.SentencePieceProcessor(model_file=path).encode(t) for t in HARD]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.Encoder(path).ids(HARD)] == want


def test_counts(clashing, library):
    rows = [*EDGE_ROWS, *((100 + i, t) for i, t in enumerate(HARD))]
    got = tokens.token_counts(clashing(rows), vocabulary(), 1024).collect()
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for d, t in rows]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert tokens.token_counts(clashing([]), vocabulary(), 1024).count() == 0


def check_packed(rows, pieces, library, capacity):
    """Every id in one piece, sequences gapless and within bounds."""
    by_seq, by_doc = {}, {}
    for p in pieces:
        by_seq.setdefault(p["sequence_id"], []).append(p)
        by_doc.setdefault(p["doc_id"], []).append(p)
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:at].tobytes())
        assert at == len(ids)
    return by_seq


def test_pack(make, spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for group in (packing.GROUP_TOKENS, 5000):
        pieces = packing.pack(docs, vocabulary(), 1024, group_tokens=group).collect()
        seqs = check_packed(rows, pieces, library, 1024)
        total = sum(p["length"] for p in pieces)
        assert len(seqs) <= -(-total // 1024) + (0 if group > 5000 else total // 5000 + 1)


def test_pack_edges(clashing, make, library):
    rows = [(d, t) for d, t in dict(r for r in EDGE_ROWS if r[0] is not None).items()]
    pieces = packing.pack(clashing(rows).coalesce(1), vocabulary(), 1024).collect()
    check_packed(rows, pieces, library, 1024)
    assert packing.pack(make([]), vocabulary(), 1024).count() == 0
    again = packing.pack(make([(4, "same"), (4, "same"), (None, "y")]), vocabulary(), 1024).collect()
    assert sorted(str(p["doc_id"]) for p in again) == ["4", "4", "None"]


def test_lowest_cost_first():
    # 600 and 500 open a sequence each; 400 goes to the cheaper one of 500, 300 to that of 600.
    pieces = packing.assign(np.array([300, 600, 400, 500]), 1024)
    assert {d: q for d, _, _, q, _ in pieces} == {1: 0, 3: 1, 2: 1, 0: 0}


def test_assign_fills_sequences():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(1, 3000, rng.integers(1, 60))
        pieces = packing.assign(lengths, 1024)
        sums = {}
        for _, _, n, q, o in sorted(pieces, key=lambda p: (p[3], p[4])):
            assert sums.get(q, 0) == o
            sums[q] = o + n
        assert max(sums.values()) <= 1024 and len(sums) == -(-lengths.sum() // 1024) and sum(sums.values()) == lengths.sum()


def test_slices_are_balanced_by_bytes():
    """One very long text among short ones is a slice of its own, and no other is much over the bound."""
    import pyarrow as pa

    from mise.llm.common import arrow_rows, portions, row_bytes
    texts = ["short text"] * 500 + ["x" * 1_000_000] + ["é" * 700] * 300 + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    slices = list(arrow_rows([batch, batch.slice(0, 0), batch.slice(400, 200)], 10_000))
    assert [x for s in slices for x in s.column(0).to_pylist()] == [*range(len(texts)), *range(400, 600)]
    sizes = [int(row_bytes(s).sum()) for s in slices]
    assert all(n <= 10_000 or s.num_rows == 1 for n, s in zip(sizes, slices)) and len(slices) < 90
    parts = list(portions(["ab"] * 10 + ["c" * 50] + [""] * 3, 8))
    assert [len(p) for p in parts] == [4, 4, 2, 1, 3] and sum(parts, []) == ["ab"] * 10 + ["c" * 50] + [""] * 3
