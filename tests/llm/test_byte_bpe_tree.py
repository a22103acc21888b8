"""Ids of the tree against the library's, and the way back."""

import hashlib
import random

import public_tokenizers
import pytest

from lakeops.llm import byte_bpe_tree
from lakeops.llm.queries import QUERIES

BY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return byte_bpe_tree.codec(*BY)


def test_pairs_decide_because_every_token_is_its_own_encoding(own):
    assert all(own.merged(token) == [rank] for token, rank in own.ranks.items() if len(token) <= 32)


@pytest.mark.parametrize("leaf", [5, 24, 300])
def test_trees_of_any_leaf_give_the_librarys_ids(own, leaf, monkeypatch):
    monkeypatch.setattr(byte_bpe_tree, "LEAF", leaf)
    rng = random.Random(leaf)
    letters = ["a", "b", "e", "é", "'", "s", "ll", " ", "  ", "\n", "\t", "!", "1", "22", "日", "本", "\x1c", "\x85", "　", "𝒳", "the", " the", "ing", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choices(letters, [rng.random() ** 4 for _ in letters], k=rng.randrange(400)))
        ids = own.encode(text)
        assert ids.tolist() == own.library.encode_ordinary(text)
        assert own.spelled(ids) == text.encode()


@pytest.mark.parametrize("unit", [["a"], ["ab", "c", "the", "ing", "é"], ["日", "本", "語"], [" "], ["'"], ["1"], ["a", " "]])
def test_very_long_runs(own, unit):
    text = "".join(random.Random(3).choices(unit, k=30_000))
    assert own.encode(text).tolist() == own.library.encode_ordinary(text)


def test_frames(spark, frame, odd, own):
    rows = byte_bpe_tree.decode(byte_bpe_tree.encode(frame(odd), *BY), *BY).collect()
    expected = [(k, tuple(own.library.encode_ordinary(t or "")), (t or "").encode()) for k, t, _ in odd]
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], tuple(r["ids"]), bytes(r["raw"]))) for r in rows)
    assert byte_bpe_tree.encode(frame([]), *BY).count() == 0


def test_query(spark, own):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in QUERIES["op13_byte_bpe_tree"](spark, sf).collect():
        ids = own.library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(texts.pop(r["doc_id"]).encode()))
    assert not texts
