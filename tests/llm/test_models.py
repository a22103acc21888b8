import math
import os
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeops.llm import chunks, i_match, ngram_model, piece_lattice, piece_sampling, token_files
from lakeops.llm.byte_bpe import Encoder
from lakeops.llm.chunks import buckets_of
from lakeops.llm.hashing import mixed
from lakeops.llm.piece_lattice import SPACE, Lattices
from lakeops.llm.queries import QUERIES
from lakeops.session import SHUFFLES_GO, scratch_path, without_shuffles

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def order(i):
    return -(1 << 63) if i is None else i


def test_encoder_equals_library(odd):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    e = Encoder(BPE)
    more = ["it's we'll  x y z 　", "a\x1cb \x1d\x85c", " lead", "trail ", "\n\n a\n b", "12ab 3.5e7 -- ... !?", "ÀÉ ñandú, Straße; Ωmega!", "don't.stop", "́a é", "👩‍👩‍👧 ok"]
    for t in [*(t[1] for t in odd), *more]:
        assert e.encode(t or "").tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_encoder_learns_each_unit_once(odd, monkeypatch):
    """Equal units of a call are looked up once, whatever the texts around them, and keep their places in order."""
    e = Encoder(BPE)
    learnt = []
    learn = Encoder.learn
    monkeypatch.setattr(Encoder, "learn", lambda self, units: (learnt.extend(units), learn(self, units))[1])
    texts = [t[1] or "" for t in odd] + ["", " a b", "a\nb", "\nb", "a  b\t", "b", "word, (word) 'word' don't word- x_y 3a a3 naïve.", "<|endoftext|>"] * 3
    for _ in range(2):
        ids, counts = e.encode_all(texts)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(learnt) == len(set(learnt)) == len(e.place)
    assert [x.tolist() for x in e.encode_all(["", ""])] == [[], [0, 0]] and [len(x) for x in e.encode_all([])] == [0, 0]


def test_token_files_round_trip(spark, frame, odd):
    path = scratch_path(spark, "test-tokens")
    token_files.write(frame(odd), path, BPE, 2, block_bytes=3000)
    e = Encoder(BPE)
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert [order(r["doc_id"]) for r in rows] == sorted(order(t[0]) for t in odd)
    got = sorted((order(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert got == sorted((order(t[0]), [*e.encode(t[1] or "").tolist(), 2]) for t in odd)
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    some = token_files.read(spark, path, only_ids=[7, 16]).collect()
    assert sorted(r["doc_id"] for r in some) == [7, 16] and {(r["doc_id"], r["start"]) for r in some} <= {(r["doc_id"], r["start"]) for r in rows}
    empty = scratch_path(spark, "test-tokens")
    token_files.write(frame([]), empty, BPE, 2)
    assert token_files.read(spark, empty).count() == 0


def test_dictionary_sample_has_one_row_an_id(frame, words):
    rows = [(7, " ".join(words(30, k))) for k in range(300)] + [(k, "a text") for k in range(100, 120)]
    sample = token_files.training_texts(frame(rows), 2000, 20_000).collect()
    assert len(sample) == 21 and token_files.training_texts(frame(rows), 5, 20_000).count() == 5
    assert {r["text"] for r in sample} <= {t for _, t in rows}


def test_token_query_by_library(spark):
    e, start = Encoder(BPE), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_token_files"](spark, SF).collect()}
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*e.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[r["doc_id"]] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_edited_texts(spark, frame, odd):
    rows = [(k, t[1]) for k, t in enumerate(odd)]
    got = {r["doc_id"]: r for r in i_match.with_edits(frame(rows)).collect()}
    by_text = defaultdict(set)
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha256(edited.encode()).hexdigest())
        by_text[t].add(got[i]["fingerprint"])
        by_text[edited].add(got[i]["edited_fingerprint"])
        assert 0 <= got[i]["near_edited"] <= 1 and (t != n or got[i]["near_next"] == 1)
    assert all(len(v) == 1 for v in by_text.values())
    assert i_match.with_edits(frame([])).count() == 0
    assert i_match.with_edits(frame([(None, "a b"), (None, None), (3, "c")])).count() == 3
    assert i_match.fingerprinted(frame(odd)).count() == len(odd)


def test_fingerprints_tell_edits_from_others(spark):
    rows = QUERIES["op4_i_match"](spark, SF).where("n_chars > 400").collect()
    assert np.mean([r["near_edited"] for r in rows]) > 10 * np.mean([r["near_next"] for r in rows])
    freq = {r["term"]: r["n"] for r in i_match.document_frequencies(spark.read.parquet(f"{SF}/documents.parquet"), "text", 3).collect()}
    own = Counter(w for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for w in set((r["text"] or "").encode().lower().split()))
    assert Counter(freq.values()) == Counter(own.values())


@pytest.mark.parametrize("half", [30, 100, 400])
def test_half_copies_are_told_one_by_one(words, half):
    bodies = [words(3 * half, 1000 * half + k, 10**7) for k in range(400)]
    raw = lambda x: " ".join(x).encode()
    terms = np.sort(np.unique(i_match.distinct_terms([raw(b) for b in bodies])[1]))
    own = i_match.fingerprints([raw(b[: 2 * half]) for b in bodies], terms)
    after = i_match.fingerprints([raw(b[:half] + b[2 * half :]) for b in bodies], terms)
    near_edited, near_next = i_match.likeness(own, after), i_match.likeness(own, np.roll(own, 1, axis=0))
    assert np.mean(near_edited > near_next) > 0.99


def kneser_ney(rows):
    tokens = [(i, [*(t or "").encode().lower().split(), "</s>"]) for i, t in rows]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [x for i, x in tokens if not out(i)]
    c = Counter(w for x in train for w in x)
    n, v = sum(c.values()), len(c)
    grams = Counter(g for x in train for g in zip(["<s>", "<s>", *x][: len(x)], ["<s>", *x[:-1]], x, strict=True))
    pairs, before = Counter((v, w) for _, v, w in grams), Counter()
    for _, w in pairs:
        before[w] += 1

    def discounts(counts):
        d = ngram_model.Discounts.of(*[sum(x == k for x in counts) for k in (1, 2, 3, 4)])
        return d.one, d.two, d.more

    def followers(counts):
        total, kinds = Counter(), defaultdict(lambda: [0, 0, 0])
        for g, k in counts.items():
            total[g[:-1]] += k
            kinds[g[:-1]][min(k, 3) - 1] += 1
        return total, kinds

    high, mid, low = discounts(grams.values()), discounts(pairs.values()), discounts(before.values())
    totals, kinds = zip(followers(grams), followers(pairs), strict=True)
    m = [sum(x == 1 for x in before.values()), sum(x == 2 for x in before.values()), sum(x > 2 for x in before.values())]
    less = lambda k, d: max(k - d[min(k, 3) - 1], 0) if k else 0

    def single(w):
        return less(before[w], low) / len(pairs) + sum(a * b for a, b in zip(low, m, strict=True)) / len(pairs) / (v + 1) if pairs else 1 / (v + 1)

    def longer(g, counts, d, which, lower):
        n = totals[which][g[:-1]]
        return less(counts[g], d) / n + sum(x * y for x, y in zip(d, kinds[which][g[:-1]], strict=True)) / n * lower if n else lower

    def chance(u, v, w):
        return longer((u, v, w), grams, high, 0, longer((v, w), pairs, mid, 1, single(w)))

    def score(x):
        return sum(math.log10(chance(*g)) for g in zip(["<s>", "<s>", *x][: len(x)], ["<s>", *x[:-1]], x, strict=True))

    return [(order(i), out(i), len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), score(x)) for i, x in tokens]


def check_scores(got, want):
    got = sorted((order(r["doc_id"]), *tuple(r)[1:]) for r in got)
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_scores_of_odd_rows(frame, odd):
    rows = [(t[0], t[1]) for t in odd]
    check_scores(ngram_model.scores(frame(rows)).collect(), kneser_ney(rows))
    assert ngram_model.scores(frame([])).count() == 0
    alone = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    assert [r["score"] for r in ngram_model.scores(frame([(i, "a b") for i in alone])).collect()] == [0.0, 0.0]


def test_score_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    scored = QUERIES["op8_ngram_model"](spark, SF)
    check_scores(scored.collect(), kneser_ney(rows))
    by = {r["held_out"]: r for r in ngram_model.perplexity(scored).collect()}
    assert by[True]["perplexity"] < by[True]["base_perplexity"]


def test_models_are_kept_as_sorted_arrays(spark, frame, tmp_path):
    texts = [(0, "a b a c"), (1, "b a b a"), (3, "c c a b")]
    folder = f"file:{tmp_path}/model"
    chunks = ngram_model.chunk_table(frame(texts), body_of=ngram_model.coded_body)
    every = lambda ids: np.ones(len(ids), bool)
    model = ngram_model.train(chunks, every, folder)
    names = sorted(x.name for x in (tmp_path / "model").iterdir())
    assert names == ["1-0.npy", "2-0.npy", "3-0.npy"] and model.folder == f"{tmp_path}/model"
    stored = np.load(tmp_path / "model" / "3-0.npy", mmap_mode="r")
    assert all((stored[k][0][1:] > stored[k][0][:-1]).all() for k in ("once", "hash"))
    assert stored["counts"].sum() + stored["once"].size == 15 and (stored["counts"] > 1).all()
    assert isinstance(stored, np.memmap)
    # other documents by the stored model
    asked = [(10, "a b"), (11, "a b a"), (14, "a b ?")]
    other = ngram_model.chunk_table(frame(asked), body_of=ngram_model.coded_body)
    got = {r["doc_id"]: r["score"] for r in ngram_model.score_chunks(other, model, every).collect()}
    assert len(got) == 3 and got[10] > got[14]
    (tmp_path / "model" / "2-0.npy").unlink()
    with pytest.raises(FileNotFoundError):
        ngram_model.score_chunks(other, model, every)
    with pytest.raises(ValueError, match="mount"):
        ngram_model.local_folder("hdfs://somewhere/model")


@pytest.mark.parametrize("buckets", [1, 2, 3, 14, 1000, 2400, 1 << 16, 100_000])
def test_stored_hashes_come_back(buckets):
    fine = ngram_model.finer_than(buckets)
    hashes = np.unique(np.random.default_rng(buckets).integers(0, 1 << 64, 200_000, dtype=np.uint64) >> fine << fine)
    hashes = np.unique(np.append(hashes, [np.uint64(0), np.uint64((1 << 64) - 1) >> fine << fine]))
    at = buckets_of(hashes, buckets)
    for k in {0, 1 % buckets, buckets // 2, buckets - 1}:
        own = hashes[at[k] : at[k + 1]]
        stored = ngram_model.narrow(3, k, buckets, own)
        assert stored.nbytes == 6 * len(own) and (stored[1:] > stored[:-1]).all()
        assert (ngram_model.widened(3, k, buckets, stored) == own).all()


def test_models_and_scores_leave_little_on_disk(spark, frame, words, monkeypatch, tmp_path):
    rows = [(k, " ".join(words(400, k, 10**6))) for k in range(60)]
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 40_000)
    bodies = []
    settle = ngram_model.settle
    monkeypatch.setattr(ngram_model, "settle", lambda some, *more: bodies.append(some) or settle(some, *more))
    check_scores(ngram_model.scores(frame(rows), folder=str(tmp_path / "model")).collect(), kneser_ney(rows))
    # what is shuffled of a chunk names its file
    assert len(bodies) == 2 + ngram_model.WAVES
    assert max(len(r["body"]) for r in bodies[0].collect()) < 400 < max(x.stat().st_size for x in Path(ngram_model.unpacked(bodies[0].first()["body"])[0]).parent.iterdir())
    files = [x for x in (tmp_path / "model").iterdir() if x.name.startswith("3-")]
    assert len(files) > 3
    n = sum(np.load(x)["once"].size + np.load(x)["hash"].size for x in files)
    assert sum(x.stat().st_size for x in files) < 6 * n + 600 * len(files)


def test_shuffles_go_with_the_query(spark):
    assert spark.conf.get(SHUFFLES_GO, None) != "true"
    with pytest.raises(ValueError), without_shuffles(spark):
        assert spark.conf.get(SHUFFLES_GO) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLES_GO, None) != "true"


@pytest.fixture(scope="module")
def pieces():
    return piece_sampling.pieces_of(PIECES, 0.2)


def segmentations(lat, node=0):
    if lat.done[node]:
        return [((), 0.0)]
    return [((int(lat.piece[e]), *s), lat.log_p[e] + p) for e in range(lat.at[node], lat.at[node + 1]) for s, p in segmentations(lat, lat.end[e])]


@pytest.mark.parametrize("bits", [3, 18])
def test_pieces_are_found_by_leading_bits(monkeypatch, bits):
    import sentencepiece

    monkeypatch.setattr(piece_lattice, "SIEVE_BITS", bits)
    pieces = piece_lattice.Pieces(PIECES, 0.2)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    texts = [SPACE + "internationalisation", "x", "日本語のテキスト", SPACE + "the", SPACE * 9, "zq" * 30, "\n"]
    lat = Lattices(texts, pieces)
    at = 0
    for k, t in enumerate(texts):
        for i in range(len(t)):
            node = lat.first[k] + i
            edges = range(lat.at[node], lat.at[node + 1])
            want = [(n, known[t[i : i + n]]) for n in range(len(t) - i, 0, -1) if t[i : i + n] in known]
            assert [(lat.end[e] - node, lat.piece[e]) for e in edges] == (want if want and want[-1][0] == 1 else [*want, (1, -1)])
            assert np.exp(lat.log_p[lat.at[node] : lat.at[node + 1]]).sum() == pytest.approx(1) and (lat.char[list(edges)] == at).all()
            at += 1
    hashes = np.array([pieces.tables[0][0][0]] * 3, np.uint64)
    assert pieces.find(pieces.lengths[0], hashes, np.array([True, False, True]))[0].tolist() == [0, 2]


def test_draws_follow_the_lattice(pieces):
    n, text = 20000, "thing"
    known = {s: math.exp(p) for s, p in segmentations(Lattices([SPACE + text], pieces))}
    assert sum(known.values()) == pytest.approx(1)
    keys = mixed(np.arange(n, dtype=np.uint64) + np.uint64(99))
    r = piece_sampling.sample_texts(keys, [text] * n, pieces, piece_sampling.Written(pieces), 3)
    assert (r.groupby("at")["ids"].nunique() == 3).all() and r["decodes"].all()
    for rank, chance in ((0, lambda s: known[s]), (1, lambda s: sum(p * known[s] / (1 - p) for q, p in known.items() if q != s))):
        seen = Counter(tuple(np.frombuffer(x, "<u2").tolist()) for x in r[r["rank"] == rank]["ids"])
        for s in sorted(known, key=known.get)[-5:]:
            assert seen[s] / n == pytest.approx(chance(s), abs=0.015)
    # inclusion scores make sums over the sample unbiased: here the sum of all chances
    assert np.exp(r["log_prob"] - r["log_inclusion"]).sum() / n == pytest.approx(1, abs=0.02)


def test_all_segmentations_of_a_short_text(pieces):
    every = segmentations(Lattices([SPACE + "to"], pieces))
    r = piece_sampling.sample_texts(np.array([5], np.uint64), ["to"], pieces, piece_sampling.Written(pieces), 50)
    assert {tuple(np.frombuffer(x, "<u2").tolist()) for x in r["ids"]} == {s for s, _ in every} and len(r) == len(every)
    assert dict(zip(map(lambda x: tuple(np.frombuffer(x, "<u2").tolist()), r["ids"]), r["log_prob"], strict=True)) == pytest.approx(dict(every), abs=1e-6)


def cut(text):
    """The words of a text as the lattices' pattern says."""
    return piece_lattice.WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def test_words_of_texts(odd):
    texts = [t[1] or "" for t in odd] + ["", " a", "a ", "a  b", "a\n\nb", "\n", "\na \n b\n", f"a{SPACE}b", " ", "\t a\r\n"]
    different, which, counts = piece_lattice.words_of(texts)
    assert [different[k] for k in which] == [w for t in texts for w in cut(t)] and len(set(different)) == len(different)
    assert counts.tolist() == [len(cut(t)) for t in texts]


def test_lattices_of_common_words_are_made_once(words, monkeypatch):
    """Words of a second batch are remembered; results are those of lattices made anew, also when all are forgotten."""
    made, make = [], piece_lattice.Lattices
    monkeypatch.setattr(piece_lattice, "Lattices", lambda w, p: (made.append(list(w)), make(w, p))[1])
    keys = np.arange(12, dtype=np.uint64)
    batches = [[" ".join(words(60, 12 * b + k, 400)) for k in range(12)] for b in range(6)]

    def results(pieces):
        return [piece_sampling.sample_texts(keys, b, pieces, piece_sampling.Written(pieces), 3) for b in batches]

    pieces = piece_lattice.Pieces(PIECES, 0.2)
    one = results(pieces)
    different = {w for b in batches for t in b for w in cut(t)}
    assert sum(map(len, made)) <= 2 * len(different) and set(pieces.known.place) <= different
    assert all(len(set(m)) == len(m) for m in made)
    made.clear()
    again = results(pieces)
    assert not made
    monkeypatch.setattr(piece_lattice, "REMEMBERED_CHARS", 300)
    forgetful = piece_lattice.Pieces(PIECES, 0.2)
    anew = results(forgetful)
    for a, b, c in zip(one, again, anew, strict=True):
        assert a["ids"].tolist() == b["ids"].tolist() == c["ids"].tolist() and a["decodes"].all()
        assert np.allclose(a["log_prob"], b["log_prob"]) and np.allclose(a["log_inclusion"], c["log_inclusion"])
    assert len(forgetful.known.place) < len(pieces.known.place)


def test_segmentations_decode(spark, frame, odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = frame(odd)
    rows = piece_sampling.segmentations(docs, PIECES, samples=2).collect()
    assert all(r["decodes"] for r in rows) and sum(r["rank"] == 0 for r in rows) == len(odd)
    texts = {t or "" for _, t, *_ in odd}
    assert {piece_sampling.decode(r["ids"], PIECES) for r in rows} == texts
    assert {model.decode(np.frombuffer(r["ids"], "<u2").tolist()) for r in rows} == texts
    again = piece_sampling.segmentations(docs.repartition(1), PIECES, samples=2).collect()
    assert sorted((order(r["doc_id"]), *tuple(r)[1:4]) for r in rows) == sorted((order(r["doc_id"]), *tuple(r)[1:4]) for r in again)
    assert piece_sampling.segmentations(frame([]), PIECES).count() == 0


def test_segmentation_query(spark):
    got = QUERIES["op7_piece_sampling"](spark, SF)
    assert got.where("NOT decodes").count() == 0
    assert got.where("rank = 0").count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.groupBy("doc_id").agg(F.countDistinct("ids_crc32").alias("n"), F.count("*").alias("m")).where("n < m").count() == 0


def test_segmentations_go_by_slices_of_batches(spark, frame, words, monkeypatch):
    """Few characters at a time, cut out of the batch without a copy; draws don't depend on the cuts."""
    texts = ["x" * (k * 37 % 90) for k in range(49)] + ["y" * 500]
    b = pa.RecordBatch.from_pydict({"doc": range(50), "text": texts})
    monkeypatch.setattr(piece_sampling, "BATCH_CHARS", 100)
    some = list(piece_sampling.stretches(iter([b, b[:0], b[:1]])))
    assert [x for s in some for x in s["doc"].to_pylist()] == [*range(50), 0]
    assert len(some) > 10 and max(len("".join(s["text"].to_pylist()[:-1])) for s in some) < 200
    assert some[1]["text"].buffers()[2].address == some[0]["text"].buffers()[2].address

    keys = np.arange(20, dtype=np.uint64)
    rows = [" ".join(words(30, 300 + k)) for k in range(20)]
    known = piece_sampling.pieces_of(PIECES, 0.2)
    whole, parts = [
        pd.concat([piece_sampling.sample_texts(keys[s:e], rows[s:e], known, piece_sampling.Written(known), 2).assign(at=lambda x, s=s: x["at"] + s) for s, e in cuts]).sort_values(["at", "rank"])
        for cuts in ([(0, 20)], [(0, 7), (7, 8), (8, 20)])
    ]
    assert whole["ids"].tolist() == parts["ids"].tolist() and np.allclose(whole["log_inclusion"], parts["log_inclusion"])
