import hashlib
import random

import pyarrow as pa
import pytest

from closeledger.llm import pieces as module
from closeledger.llm.pieces import BATCH, ENTRY_BYTES, MEMO_BYTES, SHORT, SPACE, Pieces, encoded, encoding_stage, model_bytes, op8_sentencepiece

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(model_bytes())


def test_encoding_and_decoding_equal_the_library(pieces):
    rng = random.Random(1)
    texts = ["", " ", "  a", "a  b ", "a\nb", "▁x", "<s>", "<0x41>", "\x00a", "ｂ ﬁ 日本😀", "aaa" * 80, " " * 60]
    texts += ["".join(rng.choice(" ▁abenthisré日😀\n\tﬁ.<0x") for _ in range(rng.randrange(60))) for _ in range(400)]
    for text, (n, ids, decoded) in zip(texts, pieces.encode(texts), strict=True):
        want = pieces.library.encode(text)
        assert (n, ids, decoded) == (len(want), ",".join(map(str, want)), pieces.library.decode(want))
        assert pieces.decode(want) == pieces.library.decode(want)


def test_heap_and_lockstep_agree(pieces):
    chunks = [SPACE + w for w in ("thething", "aaaaaaaa", "unbelievable", "日本語", "", "x9é", SPACE * 5 + "ab")]
    assert pieces.merge_batch(chunks) == [pieces.merge_heap(c) for c in chunks]


def test_odd_rows(spark, odd, odd_rows, nothing, pieces):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded(odd, ["doc_id"]).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in odd_rows:
        ids = pieces.library.encode(r[1] or "")
        want.append((str(r[0]), len(ids), sha(",".join(map(str, ids))), sha(pieces.library.decode(ids))))
    assert got == sorted(want)
    assert encoded(nothing, ["doc_id"]).count() == 0
    staged = encoding_stage(spark, odd, "")
    assert staged.count() == len(odd_rows) and staged.columns.count("n_tokens") == 1


def test_query(spark, sf, pieces):
    """Every row equals the library's own encoding and decoding."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = pieces.library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(pieces.library.decode(ids))))
    assert sorted(map(tuple, op8_sentencepiece(spark, sf).collect())) == sorted(want)


def test_memo_is_bounded_by_bytes(pieces):
    """Texts without spaces are one chunk each and leave nothing behind."""
    rng = random.Random(4)
    for at in range(20):
        texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=200)) for _ in range(500)]
        texts += [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(300)) for _ in range(60)]
        for text, (n, _, decoded) in zip(texts, pieces.encode(texts), strict=True):
            assert n and decoded == text
        held = sum(ENTRY_BYTES + len(c) + len(a) + len(b) for c, (a, b) in pieces.memo.items())
        assert held == pieces.held < MEMO_BYTES + 10 * BATCH and all(len(c) < SHORT for c in pieces.memo), at


def test_a_wrong_id_is_an_error(pieces, monkeypatch):
    monkeypatch.setattr(pieces, "text_of", lambda ids: "other")
    with pytest.raises(ValueError, match="decoding differs"):
        list(pieces.encode(["a text"]))


def test_chunks_that_come_again_are_not_learned_again(pieces, monkeypatch):
    """A full memo gives up the chunks that came once, not the common ones."""
    from closeledger.llm import pieces as module

    monkeypatch.setattr(module, "MEMO_BYTES", 100_000)
    pieces.memo.clear()
    pieces.held = 0
    rng, learned, learn = random.Random(5), [], pieces.learn
    monkeypatch.setattr(pieces, "learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    common = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(50)]
    for _ in range(6):
        texts = [" ".join(common + ["".join(rng.choices("abcdefgh", k=12)) for _ in range(200)]) for _ in range(4)]
        assert [d for _, _, d in pieces.encode(texts)] == texts
        assert pieces.held <= 100_000
    assert learned.count(common[0]) == 1 and set(common) <= set(pieces.memo)


def test_every_pair_is_found_and_no_other(pieces):
    import numpy as np

    keys = np.fromiter(pieces.pairs, np.int64)
    found = pieces._lookup(keys >> 32, keys & 0xFFFFFFFF)
    assert found.tolist() == list(pieces.pairs.values())
    rng = np.random.default_rng(6)
    a, b = rng.integers(-2, len(pieces.names), (2, 200_000))
    want = [pieces.pairs.get(x << 32 | y, -1) if x >= 0 <= y else -1 for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert pieces._lookup(a, b).tolist() == want


def test_the_size_of_a_slice_changes_no_row(odd):
    rows = lambda **size: sorted(map(str, encoded(odd, ["doc_id"], **size).collect()))
    assert rows(size=1) == rows()


@pytest.mark.parametrize(("made", "left"), [(lambda docs: encoding_stage(None, docs, ""), 0), (lambda docs: encoded(docs, ["doc_id"]), 1)])
def test_a_stage_leaves_no_tables_in_its_worker(spark, monkeypatch, made, left):
    docs, found = spark.createDataFrame([(1, "a word"), (2, None)], "doc_id long, text string"), []
    monkeypatch.setattr(module, "arrow_map", lambda rows, function, schema: found.append(function))
    monkeypatch.setattr(module, "_loaded", {})
    made(docs)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a word", None]), pa.array(["a word", None])], names=["doc_id", "text", "_cl_text"])
    out = list(found[0](iter([batch])))
    assert [n for b in out for n in b.column("n_tokens").to_pylist()][1] == 0
    assert len(module._loaded) == left
