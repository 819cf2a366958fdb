"""Fingerprints and their links, repeated words and repeated lines."""

import hashlib
import itertools
import re

import numpy as np
import pytest
import xxhash

from cardweave.llm import components, lines, simhash, substrings, windows
from tests.llm.conftest import ROWS

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fingerprint(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Least member of the component of each, by comparing all pairs."""
    root = list(range(len(prints)))
    for a, b in itertools.combinations(range(len(prints)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 4:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if r == old else r for r in root]
    return root


def test_near_duplicates(tricky, none):
    got = sorted(map(tuple, simhash.near_duplicates(tricky).collect()), key=str)
    rows = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [slow_fingerprint(t) for _, t in rows]
    want = [(i, f"{p:016x}", rows[r][0]) for (i, _), p, r in zip(rows, prints, slow_components(prints))]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(tricky)
    assert kept.columns == tricky.columns
    firsts = [rows[r] for r in sorted(set(slow_components(prints)))]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in firsts]
    assert simhash.one_of_each(none).count() == 0


def test_one_row_of_each_group_whatever_its_id(spark):
    a, b, c = (" ".join(f"{name}{k}" for k in range(60)) for name in "abc")
    docs = spark.createDataFrame([(3, a), (10, a), (10, b), (10, b), (11, b), (None, b), (None, c), (None, c)],
                                 "doc_id long, text string")
    kept = simhash.one_of_each(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("3", a), ("10", b), ("None", c)])


def test_a_star_with_many_links_is_dealt_over_parts(spark):
    links = [(0, k) for k in range(1, 1500)] + [(5000, 5001)]
    df = spark.createDataFrame(links, "low long, high long")
    both = df.unionByName(df.select(F.col("high").alias("low"), F.col("low").alias("high")))
    got = {(r.high, r.low): r.least for r in components._with_least(both, both.count()).collect()}
    assert got == {**{(k, 0): 0 for k in range(1, 1500)}, **{(0, k): 1 for k in range(1, 1500)}, (5001, 5000): 5000, (5000, 5001): 5001}
    plan = components._with_least(both, both.count())._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan


@pytest.mark.parametrize("spread", [6, 40])
@pytest.mark.parametrize("slice_values", [3_000, 1 << 22])
def test_ball_links_lose_no_component(spark, monkeypatch, spread, slice_values):
    monkeypatch.setattr(simhash, "SLICE_VALUES", slice_values)
    monkeypatch.setattr(simhash, "PARTITION_VALUES", 20_000)
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for centre in centres:  # chains of copies, each some bits from another one
        members = [int(centre)]
        for _ in range(25):
            value = members[rng.integers(len(members))]
            for bit in rng.choice(spread, rng.integers(1, 7), replace=True):
                value ^= 1 << int(bit)
            members.append(value)
        prints |= set(members)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.ball_links(spark.createDataFrame([(v,) for v in signed], "bits long"))
    found = {r.node: r.root for r in components.components(links).collect()}
    groups = {}
    for value, root in zip(signed, slow_components(prints)):
        groups.setdefault(root, set()).add(value)
    have = {}
    for value in signed:
        have.setdefault(found.get(value, value), set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, have.values()))


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(300)] + [(k, 1000) for k in range(1001, 1400)] + [(5, 5), (7, 6)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1400), 1000)}
    assert len(got) == 301 + 400
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_gone(rows, split, width, within):
    """By row, the positions that earlier windows cover."""
    places = {}
    for row, (i, text) in enumerate(rows):
        units = split(text)
        for k in range(len(units) - width + 1):
            places.setdefault(tuple(units[k:k + width]), []).append((float("inf") if i is None else i, row, k))
    gone = [set() for _ in rows]
    for found in places.values():
        for i, row, k in found:
            if any(j < i for j, _, _ in found) or within and any(r == row and q < k for _, r, q in found):
                gone[row] |= set(range(k, k + width))
    return gone


@pytest.fixture(params=["one group", "many groups"])
def sizes(request, monkeypatch):
    if request.param == "many groups":
        monkeypatch.setattr(windows, "GROUP_BYTES", 40_000)
        monkeypatch.setattr(windows, "BUCKET_WINDOWS", 500)


def test_substrings(tricky, none, sizes):
    got = sorted((str((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()))
                  for r in substrings.dedup_substrings(tricky).collect()))
    want = []
    for (i, text), gone in zip(ROWS, slow_gone(ROWS, lambda t: WORDS.findall(t or ""), 13, False)):
        words = WORDS.findall(text or "")
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want.append(str((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())))
    assert got == sorted(want)
    assert substrings.dedup_substrings(none).count() == 0


def test_removed_intervals_are_maximal(spark):
    shared = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"a {shared} b"), (2, f"c d {shared} e")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.dedup_substrings(docs).collect()}
    assert [tuple(x) for x in rows[2].removed] == [(2, 22)] and rows[2].kept == "c d e"
    assert rows[1].removed == []


def test_lines(tricky, none, sizes):
    got = lines.dedup_lines(tricky, counts=("n_lines", "n_removed"))
    assert got.columns == [*tricky.columns, "n_lines", "n_removed"]
    want = []
    for (i, text), gone in zip(ROWS, slow_gone(ROWS, lambda t: [] if t is None else t.split("\n"), 3, True)):
        own = [] if text is None else text.split("\n")
        left = None if text is None else "\n".join(x for k, x in enumerate(own) if k not in gone)
        want.append(str((i, left, len(own), len(gone))))
    assert sorted(str((r.doc_id, r.text, r.n_lines, r.n_removed)) for r in got.collect()) == sorted(want)
    assert {r.doc_id: (r.grp, r.id) for r in got.where("doc_id = 12").collect()} == {
        r.doc_id: (r.grp, r.id) for r in tricky.where("doc_id = 12").collect()}
    assert lines.dedup_lines(none).count() == 0
