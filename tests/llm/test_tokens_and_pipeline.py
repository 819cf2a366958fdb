"""Token ids, token files, packing and the pipeline."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cardweave.llm import packing, token_files
from cardweave.llm.bpe import TokenIds, token_ids
from cardweave.llm.oracle import ORACLES
from cardweave.llm.queries import QUERIES
from cardweave.llm.store import shared_folder
from tests.llm.conftest import ROWS

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["a  b", "\n\nx\n", "  lead", "trail ", "tab\there", "nb\xa0sp", "don't CAN'T 'S it's", "<|endoftext|> x", "é É",
       "\x1cfoo bar\x1d", "a\n\nb  c\r\n\td ", "x-y's.z, é,ö.'t", "ÀÉ naïve straße", "x" * 40 + " y, " * 9,
       "\x1cfoo bar\x1d", "123 a1b2", "日本語 テスト", "ﬁ İstanbul ẞ", "\n", "a\n", "\na", " \n", "x y", "a\x00b", "\x7f"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("memo", [3, 1 << 19])
def test_ids_are_those_of_the_library(path, memo):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    texts = [t for _, t in ROWS] + ODD * 2
    encoder = TokenIds(path, memo)
    for _ in range(2):
        ids, counts = encoder.encode(texts)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, part in zip(texts, parts):
            assert part.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_a_text_longer_than_a_chunk_is_cut_between_words(monkeypatch):
    monkeypatch.setattr("cardweave.llm.bpe.CHUNK_CHARS", 50)
    for path in (WORDS, BYTES):
        whole, encoder = Tokenizer.from_file(path), TokenIds(path, 20, names_are_text=False)
        texts = ["one two, three\n" * 20, "", "a\n\n b " * 30, "z" * 200, *ODD]
        for _ in range(2):
            ids, counts = encoder.encode(texts)
            for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
                assert part.tolist() == whole.encode(text, add_special_tokens=False).ids, text


NAMED = ["foo <|endoftext|> bar", "<|startoftext|>", "a<|endoftext|>b c", "<|ENDOFTEXT|> x", "x\n<|endoftext|>\ny", "plain text"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_queries_give_ids_of_the_plain_call(path):
    whole = Tokenizer.from_file(path)
    texts = [t for _, t in ROWS] + ODD + NAMED
    for _ in range(2):
        ids, counts = token_ids(path).encode(texts)
        for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            assert part.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_token_files_and_packing_of_texts_with_special_names(spark):
    docs = spark.createDataFrame(list(enumerate(NAMED)), "doc_id long, text string")
    plain = {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}
    path = shared_folder(spark)
    token_files.write_token_files(docs, path, WORDS, end_id=2)
    start = 0
    for row in sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.doc_id):
        want = [*plain[WORDS].encode(NAMED[row.doc_id], add_special_tokens=False).ids, 2]
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == want and row.start == start
        start += len(want)
    want = {k: np.array([*plain[BYTES].encode(t, add_special_tokens=False).ids, 0], "<u4") for k, t in enumerate(NAMED)}
    assert check_packed(packing.pack_documents(docs, BYTES, end_id=0).collect(), want, packing.Limits()) == 0


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2 ** bits, 1000).astype(np.uint32)
    for n in (0, 1, 63, 64, 65, 1000):
        data = token_files.pack_bits(ids[:n], bits)
        assert len(data) == 8 * -(-n * bits // 64)
        assert (token_files.unpack_bits(data, bits, 0, n) == ids[:n]).all()
    assert (token_files.unpack_bits(data, bits, 333, 77) == ids[333:410]).all()


def expected(path, end):
    whole = Tokenizer.from_file(path)
    return [(i, np.array([*whole.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for i, t in ROWS]


@pytest.mark.parametrize("block_ids", [50, 1 << 16])
def test_token_files(spark, tricky, none, block_ids):
    path = shared_folder(spark)
    token_files.write_token_files(tricky, path, WORDS, end_id=2, block_ids=block_ids)
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == sorted((str(i), w.tobytes()) for i, w in expected(WORDS, 2))
    at = 0
    for row in got:
        assert row.start == at and 4 * row.n_tokens == len(row.ids)
        at += row.n_tokens
    every = np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4")
    assert (token_files.read_range(spark, path, 30, 500) == every[30:530]).all()
    assert token_files.read_blocks(spark, path).select("bits").distinct().collect()[0].bits == 16
    empty = shared_folder(spark)
    token_files.write_token_files(none, empty, WORDS, end_id=2)
    assert token_files.read_documents(spark, empty).count() == 0


def check_packed(pieces, documents, limits):
    """Every id once, no limit passed, no gap; the ids that padding would add."""
    own, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc, ids in documents.items():
        parts = sorted(own[doc], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in parts) == ids.tobytes()
        assert [p.start for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert all(p.doc_tokens == len(ids) and 4 * p.length == len(p.ids) for p in parts)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        size = sum(p.length for p in parts)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert size <= limits.tokens and len(parts) <= limits.segments
        assert sum(p.loss_tokens for p in parts) <= limits.loss
        padding += 0 if size & (size - 1) == 0 else limits.tokens - size
    return padding


def test_packing_of_documents(tricky, none):
    docs = tricky.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    pieces = packing.pack_documents(docs, BYTES, end_id=0).collect()
    assert check_packed(pieces, {i: w for i, w in expected(BYTES, 0) if i}, packing.Limits()) == 0
    assert packing.pack_documents(none, BYTES, end_id=0).count() == 0
    whole = packing.pack_documents(tricky, BYTES, end_id=0)
    assert whole.agg(F.sum("length")).first()[0] == sum(len(w) for _, w in expected(BYTES, 0))


@pytest.mark.parametrize("limits", [packing.Limits(64, 5, 40, 16), packing.Limits(128, 64, 128, 32), packing.Limits(32, 2, 9, 8)])
def test_packing_under_three_limits(spark, limits):
    rng = np.random.default_rng(limits.tokens)
    rows = [(k, np.arange(n, dtype="<u4").tobytes(), int(rng.integers(0, n + 1)))
            for k, n in enumerate(rng.integers(1, 150, 200).tolist())]
    examples = spark.createDataFrame([*rows, (900, b"", 0), (901, None, None)], "doc_id long, ids binary, prompt long")
    pieces = packing.pack_examples(examples.repartition(3), limits).collect()
    assert check_packed(pieces, {k: np.frombuffer(ids, "<u4") for k, ids, _ in rows}, limits) == 0
    assert not {p.doc_id for p in pieces} & {900, 901}


def test_pipeline(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = spark.createDataFrame(stage(spark, before, folder).toPandas(), docs.schema)
        assert kept.columns == docs.columns
        assert kept.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert 0 < kept.count() < docs.count()
    run = corpus_pipeline.run(spark, folder)
    pieces = run.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept.collect()}
    assert all(r.n == r["all"] for r in pieces)


def test_registered(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)
