import hashlib

import numpy as np
import pytest

from matchlake.llm import bpe
from matchlake.llm.queries import vocabulary

SCHEMA = (["doc_id"], bpe.digests, bpe.DIGESTS)


def expected(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    out = []
    for r in docs.select("doc_id", "text").collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which, limit", [("small_docs", 1 << 25), ("small_docs", 20_000), ("edge_docs", 1 << 20)])
def test_equals_the_library(request, which, limit):
    docs = request.getfixturevalue(which)
    got = bpe.encode_decode(docs, vocabulary(), *SCHEMA, block_bytes=limit, buckets=5)
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs)


def test_no_rows(no_docs):
    assert bpe.encode_decode(no_docs, vocabulary(), *SCHEMA).collect() == []


def test_carried_columns_with_clashing_names(edge_docs):
    got = bpe.encode_decode(edge_docs, vocabulary(), ["node", "block", "doc_id"], bpe.ids_and_digests, bpe.IDS_AND_DIGESTS)
    assert got.columns[:3] == ["node", "block", "doc_id"]
    assert {(r.node, r.block) for r in got.collect()} == {("node", "block")}
    assert all(len(r.ids) == r.n_tokens for r in got.collect())


def test_words_holding_the_separator():
    words = ["ab", bpe.SEPARATOR, "x" + bpe.SEPARATOR + "y", "cd"]
    t = bpe.tokenizer(vocabulary())
    flat, counts = bpe.encode_words(vocabulary(), words)
    parts = np.split(flat, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [t.encode(w, add_special_tokens=False).ids for w in words]


def test_blocks_do_not_depend_on_batches():
    import pyarrow as pa
    rows = pa.record_batch({"t": ["a" * n for n in (5, 3, 9, 1, 1, 20, 2)]})
    cut = lambda *at: [rows.slice(a, b - a) for a, b in zip((0, *at), (*at, 7))]
    sizes = lambda batches: [t.num_rows for t in bpe.row_blocks(iter(batches), "t", 10)]
    assert sizes(cut()) == sizes(cut(1, 2)) == sizes(cut(3)) == sizes(cut(1, 2, 3, 4, 5, 6)) == [2, 2, 1, 1, 1]


def test_refuses_a_vocabulary_with_a_decoder(edge_docs):
    import public_tokenizers
    with pytest.raises(ValueError):
        bpe.encode_decode(edge_docs, public_tokenizers.path("byte_bpe_50k.json"), *SCHEMA)


def test_words_of_every_kind_equal_the_library():
    import random
    r = random.Random(8)
    letters = "abcXYZéÉßßİıΣσςÅKΩÑñǅŉﬁ한글漢字あ"
    odd = letters + ".,;:!?'’-_0123½́̇  　​<|>#😀"
    words = ["".join(r.choice(letters if r.random() < 0.5 else odd) for _ in range(r.randint(1, 9))) for _ in range(6000)]
    words += ["a", ".", ",", "a.", "a..", "don't", "I'll", "x'S", "ΑΣ", "ΑΣ.", "İ", "İ.", bpe.SEPARATOR, "<|endoftext|>."]
    t = bpe.tokenizer(vocabulary())
    flat, counts = bpe.encode_words(vocabulary(), words)
    parts = [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])]
    for w, p in zip(words, parts):
        assert p == t.encode(w, add_special_tokens=False).ids, w
    assert len(bpe.word_ends(vocabulary())) > 0
