"""Phrase automata and collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from cardweave.llm import collocations
from cardweave.llm.automata import Builder
from cardweave.llm.queries import QUERIES
from tests.llm.conftest import LONG, ROWS

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slow(rows, least=30, held=80, top=2000):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            for size in range(1, 5):
                counts[lang].update(tuple(own[i:i + size]) for i in range(len(own) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= held * f[p[i:i + size]]:
                        dropped.add(p[i:i + size])
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_automaton_finds_weights_and_shares_states():
    words = random.Random(1)
    phrases = Counter(tuple(words.choice("abcd") for _ in range(words.randint(0, 4))) for _ in range(900))
    builder = Builder()
    for phrase in sorted(phrases.elements()):
        builder.add(phrase, 2)
    built = builder.done()
    assert dict(built.phrases()) == {p: 2 * n for p, n in phrases.items()}
    assert [p for p, _ in built.phrases()] == sorted(phrases)
    assert all(built.weight(p) == 2 * n for p, n in phrases.items())
    assert built.weight(("a", "x")) == built.weight(("a",) * 5) == 0
    assert len(built.finals) < len(phrases) / 2
    with pytest.raises(ValueError):
        builder = Builder()
        builder.add(("b",), 1)
        builder.add(("a",), 1)
    assert list(Builder().done().phrases()) == []


def test_collocations_of_the_given_table(spark, folder):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    want = slow(rows)
    result = QUERIES["op12_collocations"](spark, folder)
    assert [t for _, t in result.dtypes] == ["string", "bigint", "string", "bigint", "bigint", "bigint", "bigint", "bigint"]
    assert got(result) == want and want
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = slow(rows, least=5, top=300)
    assert got(collocations.mine_collocations(docs, least=5, top=300)) == more and len(more) > 300


@pytest.mark.parametrize("tiny", [False, True])
def test_odd_texts(spark, monkeypatch, tiny):
    if tiny:
        for name, value in {"SHARD_BYTES": 2000, "LONG_TEXT": 500, "BUCKET_CELLS": 64, "AUTOMATON_PHRASES": 50,
                            "RANGE_ROWS": 500, "REQUESTS": 40, "CELL_BITS": 0}.items():
            monkeypatch.setattr(collocations, name, value)
    texts = [t for _, t in ROWS if t != LONG] + ["A B c. a b\tC;a b c\x01d a\x01 b\x00 c", "x y x y x y", "É é İ ß", "hot pair " * 300]
    rows = [(lang, t) for t in texts for lang in ("en", None, "und", "", "de") for _ in range(3)] + [("en", LONG)]
    clashing = ", ".join(f"{c} int" for c in ("words", "a", "f", "l", "r", "n", "score", "phrase", "shard", "rank"))
    df = spark.createDataFrame([(*r, *[1] * 10) for r in rows], f"lang string, text string, {clashing}").repartition(3)
    assert got(collocations.mine_collocations(df, least=4, top=40)) == slow(rows, least=4, top=40)


def test_no_phrases(spark, none):
    for text in (None, "", "one", " . "):
        df = spark.createDataFrame([("en", text)], "lang string, text string")
        assert got(collocations.mine_collocations(df)) == []
    assert got(collocations.mine_collocations(none, lang="text")) == []


def test_texts_and_counts_move_compressed(spark, monkeypatch):
    kept, stored = {}, collocations.stored

    def noted(df):
        out = stored(df)
        kept[frozenset(out.columns)] = out
        return out
    monkeypatch.setattr(collocations, "stored", noted)
    text = " ".join(f"word{k % 90} and{k % 7}" for k in range(900))
    df = spark.createDataFrame([("en", text)] * 64, "lang string, text string").repartition(64)
    assert got(collocations.mine_collocations(df)) == slow([("en", text)] * 64)
    shards = next(d for c, d in kept.items() if {"shard", "text"} <= c)
    counts = next(d for c, d in kept.items() if {"lang", "f"} <= c)
    assert shards.selectExpr("sum(octet_length(text))").first()[0] < 64 * len(text) / 2
    moved = counts.mapInArrow(collocations._blocks([]), collocations._BLOCK).selectExpr("sum(n)", "sum(octet_length(block))").first()
    assert moved[0] == counts.count() > 10_000 and moved[1] < 10 * moved[0]


def test_blocks_of_ranges_hold_every_phrase_once():
    letters = random.Random(2)
    shards = [Counter(tuple("".join(letters.choices("\x00\x01\x02aé", k=letters.randint(1, 3))) for _ in range(letters.randint(0, 4)))
                      for _ in range(400)) for _ in range(3)]
    batches, keys = [], set()
    for lang in ("", "de"):
        for shard in shards:
            parts = []
            for p, f in shard.items():
                names = pa.array([w.encode() for w in p], pa.large_binary())
                parts.append(collocations._phrases(collocations._escaped(names), lang, [np.array([k]) for k in range(len(p))], [f])
                             if p else pa.table({"lang": [lang], "key": pa.array([b""]), "f": [f]}))
            rows = pa.concat_tables(parts).sort_by("key")
            assert [tuple(collocations._listed(k)) for k in rows.column("key").to_pylist()] == sorted(shard)
            batches += rows.combine_chunks().to_batches()
            keys |= {(lang, k) for k in rows.column("key").to_pylist()}
    edges = sorted(random.Random(3).sample(sorted(keys), 9))
    blocks = pa.Table.from_batches(list(collocations._blocks(edges)(iter(batches))))
    found = []
    for number in sorted(set(blocks.column("range").to_pylist())):
        own = blocks.filter(pc.equal(blocks.column("range"), number))
        for row in collocations._unite(1)(own).to_pylist():
            found += [(row["lang"], p, f) for p, f in collocations._loaded(row).phrases()]
    total = sum(shards, Counter())
    assert found == [(lang, p, total[p]) for lang in ("", "de") for p in sorted(total)]
    assert len(set(blocks.column("range").to_pylist())) == 10
