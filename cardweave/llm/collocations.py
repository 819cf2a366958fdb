"""Phrase collocation mining with weighted acyclic automata.

1. Texts are packed, where they lie, into compressed shards of some megabytes of one language.
2. A shard counts the cells, hashes of a width that follows the input, of its
   sequences of one to four words. Cells are summed in buckets, and a shard learns
   which of its cells reach the least count. No sequence that reaches it is lost.
3. A shard gives the words and counts of its sequences in such cells, exactly.
4. These go sorted, in compressed blocks by range of beginnings, into automata that
   add up the counts of all shards; what misses the least count now goes.
5. Candidates' parts are sent to the automata of their ranges and composed with them.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cardweave.llm.automata import Builder, CountTransducer, Phrase
from cardweave.llm.store import shipped, stored, text_bytes

LONGEST = 4
LEAST = 30
#: A candidate is dropped if a longer one holds it that has this percentage of its count.
HELD = 80
TOP = 2000
#: Bytes of the texts of a shard; characters from which a text is first cut at its piece ends.
SHARD_BYTES = 3 << 20
LONG_TEXT = 1 << 20
#: Cells that a bucket sums, on average, and cells for each sequence of the input.
BUCKET_CELLS = 1 << 21
CELL_BITS = 4
#: Phrases of an automaton, rows of counts that a task unites, and requests that a task composes.
AUTOMATON_PHRASES = 1 << 16
RANGE_ROWS = 1 << 19
#: Rows of counts by which the edges of a range are chosen, on average; the edges decide sizes alone.
RANGE_SAMPLE = 32
REQUESTS = 1 << 17

# What ends a piece, and what parts words.
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLASSES = bytes(10 if c in _ENDS else 32 if c in _BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))

_SHARD = "shard long, lang string, size long, text binary"
_CODEC = "zstd"
_COUNTS = "lang string, words array<string>, f long"
_KEYS = "lang string, key binary, f long"
_BLOCK = "range int, lang string, n long, size long, block binary"
_AUTOMATON = "lang string, first array<string>, vocabulary array<string>, arcs binary, finals binary, weights binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one language in a row, in shards."""
    number = TaskContext.get().partitionId() << 32
    open_: dict[str, tuple[list[bytes], int]] = {}

    def shard(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        nonlocal number
        number += 1
        text = b"\n".join(texts)
        # Stored once and shuffled once: in a closer codec than Spark's own.
        return pa.RecordBatch.from_arrays([
            pa.array([number - 1], pa.int64()), pa.array([lang], pa.string()), pa.array([len(text)], pa.int64()),
            pa.array([pa.compress(text, _CODEC, asbytes=True)], pa.binary())], names=["shard", "lang", "size", "text"])
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            texts, size = open_.get(lang, ([], 0))
            texts.append(text.as_py().encode("utf-8", "surrogatepass"))
            size += len(texts[-1]) + 1
            if size >= SHARD_BYTES:
                yield shard(lang, texts)
                texts, size = [], 0
            open_[lang] = texts, size
            if sum(size for _, size in open_.values()) > 4 * SHARD_BYTES:  # many languages at once
                for name, (own, _) in open_.items():
                    if own:
                        yield shard(name, own)
                open_.clear()
    for lang, (texts, _) in open_.items():
        if texts:
            yield shard(lang, texts)


def _text(size: pa.Int64Scalar, text: pa.BinaryScalar) -> bytes:
    return pa.decompress(text.as_buffer(), size.as_py(), _CODEC, asbytes=True)


def _words(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words; by word its number and its piece."""
    data = np.frombuffer(text.translate(_CLASSES), np.uint8)
    gap = (data == 32) | (data == 10)
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    piece = np.cumsum(data == 10, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[~gap]))])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece


def _cells(lang: str, names: pa.Array, word: np.ndarray, piece: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length the first words of the sequences, and their cells."""
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names.to_pylist()), np.uint64, len(names))
    unit = hashes[word]
    out, rolled = [], unit
    for length in range(1, LONGEST + 1):
        n = max(0, len(word) - length + 1)
        if length > 1:
            rolled = rolled[:n] * np.uint64(0x9E3779B97F4A7C15) + unit[length - 1:][:n]
        at = np.flatnonzero(piece[:n] == piece[length - 1:][:n])
        mixed = rolled[at] ^ (rolled[at] >> np.uint64(32))
        mixed = (mixed + np.uint64(length)) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        out.append((at, mixed >> np.uint64(64 - bits)))
    return out


def _cuts(cells: np.ndarray, bits: int, bucket_bits: int) -> np.ndarray:
    edges = np.arange(1, 1 << bucket_bits, dtype=np.uint64) << np.uint64(bits - bucket_bits)
    return np.concatenate([[0], np.searchsorted(cells, edges), [len(cells)]])


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes, which the first byte tells: first bytes of all, then second bytes, and so on.

    The last bytes are nearly all zero and vanish when Spark compresses what it shuffles.
    """
    size = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    return bytes([size]) + np.ascontiguousarray(planes.T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.reshape(-1).view("<u8")


def _ranked(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``2 ** bits`` in order; by value its place among them."""
    room = len(values).bit_length()
    if bits + room > 64:
        return np.unique(values, return_inverse=True)
    keys = np.sort(values << np.uint64(room) | np.arange(len(values), dtype=np.uint64))
    at = (keys & np.uint64((1 << room) - 1)).astype(np.int64)
    keys >>= np.uint64(room)
    new = np.diff(keys, prepend=~keys[:1]) != 0
    which = np.empty(len(values), np.int64)
    which[at] = np.cumsum(new) - 1
    return keys[new], which


def _send(bits: int, bucket_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of each shard with their counts, by bucket."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lang, size, text in zip(*(batch.column(i) for i in range(4))):
                words = _words(_text(size, text))
                every = np.concatenate([c for _, c in _cells(lang.as_py(), *words, bits)])
                cells, counts = np.unique(every, return_counts=True)
                cuts = _cuts(cells, bits, bucket_bits)
                full = np.flatnonzero(np.diff(cuts)).tolist()
                own = [slice(cuts[b], cuts[b + 1]) for b in full]
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), pa.array([number.as_py()] * len(full), pa.int64()),
                    pa.array([_packed(np.diff(cells[s], prepend=np.uint64(b) << np.uint64(bits - bucket_bits)))
                              for b, s in zip(full, own)], pa.binary()),
                    pa.array([_packed(counts[s]) for s in own], pa.binary())],
                    names=["bucket", "shard", "cells", "counts"])
    return send


def _answer(least: int, bits: int) -> Callable[[pa.Table], pa.Table]:
    """Which cells of each shard reach the least count over all shards, one bit a cell; ``bits`` within a bucket."""
    def answer(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(_unpacked(x.as_py()), dtype=np.uint64) for x in table.column("cells")]
        counts = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
        _, which = _ranked(np.concatenate(parts), bits)
        enough = (np.bincount(which, counts) >= least)[which]  # sums of doubles are exact here
        bounds = np.cumsum([0, *map(len, parts)]).tolist()
        return pa.table({
            "shard": table.column("shard"), "bucket": table.column("bucket"),
            "enough": pa.array([np.packbits(enough[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())})
    return answer


def _escaped(names: pa.Array) -> pa.Array:
    """Words without zero bytes, which part the words of a key; keys are then in the order of their lists of words."""
    return pc.replace_substring(pc.replace_substring(names.cast(pa.binary()), b"\x01", b"\x01\x02"), b"\x00", b"\x01\x01")


def _listed(key: bytes) -> list[str]:
    if b"\x01" in key:
        return [w.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01").decode() for w in key.split(b"\x00")]
    return key.decode().split("\x00") if key else []


def _phrases(names: pa.Array, lang: str, sequences: list[np.ndarray], counts: np.ndarray) -> pa.Table:
    """Rows of counts; ``sequences`` has the word numbers by place in the sequence."""
    keys = pc.binary_join_element_wise(*(names.take(pa.array(s, pa.int64())) for s in sequences), b"\x00")
    return pa.table({"lang": pa.array([lang] * len(counts), pa.string()), "key": keys, "f": pa.array(counts, pa.int64())})


def _exact(bits: int, bucket_bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Sequences of a shard whose cells reach the least count, with their counts there."""
    def exact(shard: pa.Table, answers: pa.Table) -> pa.Table:
        lang = shard.column("lang")[0].as_py()
        names, word, piece = _words(_text(shard.column("size")[0], shard.column("text")[0]))
        found = _cells(lang, names, word, piece, bits)
        cells, which = _ranked(np.concatenate([c for _, c in found]), bits)
        which = np.split(which, np.cumsum([len(at) for at, _ in found])[:-1])
        cuts, enough = _cuts(cells, bits, bucket_bits), np.zeros(len(cells), bool)
        for bucket, own in zip(answers.column("bucket").to_pylist(), answers.column("enough").to_pylist()):
            n = cuts[bucket + 1] - cuts[bucket]
            enough[cuts[bucket]:cuts[bucket + 1]] = np.unpackbits(np.frombuffer(own, np.uint8), count=n)
        # The words of the shard as a phrase without words: how many there are in all.
        out = [pa.table({"lang": pa.array([lang], pa.string()), "key": pa.array([b""]), "f": pa.array([len(word)], pa.int64())})]
        names = _escaped(names)
        before, number = None, np.zeros(0, np.int64)
        small = len(word) < 1 << 21  # then a number, a word and a place fit 64 bits
        for length, (at, own) in enumerate(zip([at for at, _ in found], which), 1):
            at = at[enough[own]]
            if before is not None:  # both sequences of one word less reach the count as well
                at = at[before[at] & before[at + 1]]
                key = number[at] << 22 | word[at + length - 1] if small else number[at] << 32 | word[at + length - 1]
            else:
                key = word[at]
            distinct, same = _ranked(key.astype(np.uint64), 43 if small else 64)
            first = np.zeros(len(distinct), np.int64)
            first[same] = at
            out.append(_phrases(names, lang, [word[first + k] for k in range(length)], np.bincount(same, minlength=len(distinct))))
            before, number = np.zeros(len(word) + 1, bool), np.zeros(len(word) + 1, np.int64)
            before[at], number[at] = True, same
        # In order, so that neighbours share their beginnings.
        return pa.concat_tables(out).sort_by("key")
    return exact


def _automaton(lang: str, first: list[str], done: CountTransducer) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()), pa.array([first], pa.list_(pa.string())),
        pa.array([done.vocabulary], pa.list_(pa.string())), pa.array([done.arcs.astype("<i8").tobytes()], pa.binary()),
        pa.array([done.finals.tobytes()], pa.binary()), pa.array([done.weights.astype("<i8").tobytes()], pa.binary())],
        names=["lang", "first", "vocabulary", "arcs", "finals", "weights"])


def _loaded(row: dict) -> CountTransducer:
    return CountTransducer(row["vocabulary"], np.frombuffer(row["arcs"], "<i8").reshape(-1, 4),
                           np.frombuffer(row["finals"], bool), np.frombuffer(row["weights"], "<i8"))


def _blocks(edges: list[tuple[str, bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of counts of one shard and range in a row, compressed."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, keys, f = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            new = pc.or_(pc.not_equal(langs[1:], langs[:-1]), pc.less(batch.column(1)[1:], batch.column(1)[:-1]))
            bounds = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist(), len(keys)]
            rows = []
            for start, stop in zip(bounds, bounds[1:]):
                lang = langs[start].as_py()
                range_ = bisect.bisect_right(edges, (lang, keys[start]))
                while start < stop:
                    if range_ < len(edges) and edges[range_] <= (lang, keys[stop - 1]):
                        end = bisect.bisect_left(keys, edges[range_][1], start, stop)
                    else:
                        end = stop
                    if end > start:
                        block = _packed(f[start:end]) + b"\n".join(keys[start:end])
                        rows.append((range_, lang, end - start, len(block), pa.compress(block, _CODEC, asbytes=True)))
                    start, range_ = end, range_ + 1
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["range", "lang", "n", "size", "block"])
    return blocks


def _unite(least: int) -> Callable[[pa.Table], pa.Table]:
    """Automata of a range's sequences, with the counts of all shards added up."""
    def unite(table: pa.Table) -> pa.Table:
        langs: dict[str, list[pa.Table]] = {}
        for lang, n, size, block in zip(*(table.column(c) for c in ("lang", "n", "size", "block"))):
            data = _text(size, block)
            end = 1 + data[0] * n.as_py()
            langs.setdefault(lang.as_py(), []).append(pa.table({
                "key": pa.array(data[end:].split(b"\n"), pa.binary()), "f": pa.array(_unpacked(data[:end]).astype(np.int64))}))
        out = []
        for lang, counts in langs.items():
            rows = pa.concat_tables(counts).group_by("key").aggregate([("f", "sum")]).rename_columns({"f_sum": "f"})
            rows = rows.filter(pc.or_(pc.greater_equal(rows.column("f"), least), pc.equal(rows.column("key"), b""))).sort_by("key")
            for at in range(0, rows.num_rows, AUTOMATON_PHRASES):
                own, builder = rows.slice(at, AUTOMATON_PHRASES), Builder()
                for key, f in zip(own.column("key").to_pylist(), own.column("f").to_pylist()):
                    builder.add(tuple(_listed(key)), f)
                out.append(_automaton(lang, _listed(own.column("key")[0].as_py()), builder.done()))
        return pa.Table.from_batches(out, _automaton("", [], Builder().done()).schema)
    return unite


def _parts(row: dict, firsts: list[tuple[str, list[str]]]) -> Iterator[tuple[Phrase, int, list[tuple[int, int, int]]]]:
    """Candidates of an automaton, each with (automaton, cut, side) of its parts."""
    for words, a in _loaded(row).phrases():
        if len(words) > 1:
            yield words, a, [(bisect.bisect_right(firsts, (row["lang"], list(part))) - 1, k, side)
                             for k in range(1, len(words)) for side, part in enumerate((words[:k], words[k:]))]


def _asked(firsts: list[tuple[str, list[str]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How many parts belong to each automaton."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = Counter(target for _, _, parts in _parts(row, firsts) for target, _, _ in parts)
                yield pa.RecordBatch.from_arrays([pa.array(list(numbers), pa.int32()), pa.array(list(numbers.values()), pa.int64())],
                                                 names=["target", "n"])
    return count


def _requests(firsts: list[tuple[str, list[str]]], shares: list[int]
              ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parts of all candidates, with the automaton that each part belongs to."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.int32(), pa.int32()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["target", "share", "lang", "words", "a", "k", "side"])
        for batch in batches:
            for row in batch.to_pylist():
                for words, a, parts in _parts(row, firsts):
                    spread = xxhash.xxh3_64_intdigest(" ".join(words))
                    rows += [(target, spread % shares[target], row["lang"], words, a, k, side) for target, k, side in parts]
                    if len(rows) >= 10_000:
                        yield out()
                        rows = []
        if rows:
            yield out()
    return ask


_REQUEST = "target int, share int, lang string, words array<string>, a long, k int, side int"


def _compose(requests: pa.Table, automaton: pa.Table) -> pa.Table:
    """Counts of the parts that were asked for."""
    held = _loaded(automaton.to_pylist()[0])
    weights = []
    for words, k, side in zip(*(requests.column(c).to_pylist() for c in ("words", "k", "side"))):
        weights.append(held.weight(tuple(words[k:] if side else words[:k])))
    return requests.drop_columns(["target", "share"]).append_column("f", pa.array(weights, pa.int64()))


def phrase_automata(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST) -> DataFrame:
    """Stored automata of all phrases of one to four words that occur at least ``least`` times.

    A row is one automaton of a language and a range of phrases; ``first`` is its
    first phrase. The phrase without words has the number of all words.
    """
    kept = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where(
        F.col("text").isNotNull())
    size = text_bytes(kept, "text")
    sequences = max(1, LONGEST * size // 5)
    bits = min(60, sequences.bit_length() + CELL_BITS)
    bucket_bits = min(bits, (sequences // BUCKET_CELLS).bit_length())
    # A very long text is cut where pieces end, which no sequence crosses.
    cut = F.when(F.length("text") < LONG_TEXT, F.array("text")).otherwise(F.split("text", r"[.,;:!?\n\x0B\f\r]"))
    shards = stored(shipped(kept.select("lang", F.explode(cut).alias("text"))).mapInArrow(_pack, _SHARD))
    sent = shards.mapInArrow(_send(bits, bucket_bits), "bucket int, shard long, cells binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer(least, bits - bucket_bits), "shard long, bucket int, enough binary")
    counts = stored(shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_exact(bits, bucket_bits), _KEYS))
    rows = counts.count()
    edges: list[tuple[str, bytes]] = []
    if rows > RANGE_ROWS:
        some = counts.select("lang", "key").sample(min(1.0, RANGE_SAMPLE / RANGE_ROWS), seed=7)
        edges = sorted({*sorted((r["lang"], bytes(r["key"])) for r in some.toLocalIterator())[RANGE_SAMPLE::RANGE_SAMPLE]})
    blocks = counts.mapInArrow(_blocks(edges), _BLOCK)
    return stored(blocks.groupBy("range").applyInArrow(_unite(least), _AUTOMATON))


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            own = list(_loaded(row).phrases())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(own), pa.string()), pa.array([p for p, _ in own], pa.list_(pa.string())),
                 pa.array([f for _, f in own], pa.int64())], names=["lang", "words", "f"])


def _composed(automata: DataFrame) -> DataFrame:
    """(lang, words, a, l1, r1, ..): candidates with the counts of both parts of every cut."""
    # One row an automaton of 65,536 phrases: a list of where each begins.
    firsts = sorted((r["lang"], list(r["first"])) for r in automata.select("lang", "first").toLocalIterator())
    place = {(lang, tuple(first)): n for n, (lang, first) in enumerate(firsts)}
    counted = automata.mapInArrow(_asked(firsts), "target int, n long").groupBy("target").agg(F.sum("n").alias("n"))
    shares = [1] * len(firsts)
    for row in counted.toLocalIterator():
        shares[row["target"]] = -(-row["n"] // REQUESTS)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                target = place[one.column(0)[0].as_py(), tuple(one.column(1)[0].as_py())]
                for share in range(shares[target]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([target], pa.int32()), pa.array([share], pa.int32()), *one.columns],
                        names=["target", "share", *one.schema.names])
    dealt = automata.mapInArrow(copies, "target int, share int, " + _AUTOMATON)
    asked = automata.mapInArrow(_requests(firsts, shares), _REQUEST)
    parts = asked.groupBy("target", "share").cogroup(dealt.groupBy("target", "share")).applyInArrow(
        lambda requests, held: _compose(requests, held) if requests.num_rows else _NOTHING,
        "lang string, words array<string>, a long, k int, side int, f long")
    return parts.groupBy("lang", "words").agg(F.first("a").alias("a"), *[
        F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{name}{k}")
        for k in range(1, LONGEST) for side, name in enumerate("lr")])


_NOTHING = pa.table({"lang": pa.array([], pa.string()), "words": pa.array([], pa.list_(pa.string())),
                     "a": pa.array([], pa.int64()), "k": pa.array([], pa.int32()), "side": pa.array([], pa.int32()),
                     "f": pa.array([], pa.int64())})


def mine_collocations(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, held: int = HELD,
                      top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to four words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at blanks
    and tabs. ``a`` is the count of the phrase, ``l`` and ``r`` are those of its parts at the cut with the
    least ``floor(2000000 * a / (l + r))``, the earliest one where several have it; that is the score, and
    ``n`` is the number of words of the language. Phrases below ``least`` are no candidates; those that a
    longer candidate with at least ``held`` percent of their count holds are dropped. Order: score and
    ``a`` descending, then the phrase in byte order.

    A null text has no words, a null language is ``und``, other columns are ignored; rows that repeat
    count each. Without candidates the result is empty. A text of more than a million characters is
    handled piece by piece.
    """
    automata = phrase_automata(docs, lang=lang, text=text, least=least)
    phrases = automata.mapInArrow(_enumerate, _COUNTS)
    totals = phrases.where(F.size("words") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    inside = ", ".join(f"transform(sequence(1, size(words) - {length - 1}), at -> slice(words, at, {length}))"
                       for length in range(2, LONGEST))
    longer = phrases.where(F.size("words") > 2).select(
        "lang", "f", F.size("words").alias("size"), F.expr(f"explode(flatten(array({inside})))").alias("words"))
    longer = longer.where(F.size("words") < F.col("size"))
    most = longer.groupBy("lang", "words").agg(F.max("f").alias("most"))
    cuts = ", ".join(f"IF(l{k} IS NULL, NULL, struct(CAST(2000000 AS DECIMAL(20, 0)) * CAST(a AS DECIMAL(18, 0)) "
                     f"div (CAST(l{k} AS DECIMAL(20, 0)) + CAST(r{k} AS DECIMAL(20, 0))) AS score, {k} AS k, l{k} AS l, r{k} AS r))"
                     for k in range(1, LONGEST))
    scored = _composed(automata).withColumn("best", F.expr(f"array_min(filter(array({cuts}), c -> c IS NOT NULL))"))
    left = (scored.join(most, ["lang", "words"], "left")
            .where(F.col("most").isNull() | (F.expr(f"CAST(100 AS DECIMAL(20, 0)) * most < CAST({held} AS DECIMAL(20, 0)) * a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = left.select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r",
                       F.col("best.score").cast("long").alias("score"))
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
