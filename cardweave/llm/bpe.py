"""Token ids of whole texts by the ``tokenizers`` library, with a memo of words.

Where the tokenizer never joins what white space parts, a text's ids are those
of its words in a row. Words are split and numbered by Arrow, some megabytes of
texts at a time, so each distinct word of these is looked up once. The words a
worker has met are remembered until they have not been met for long; the library
encodes each new word. Texts for which that parting is not safe are encoded
whole, so the ids are always those that the library gives for the whole text.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Words that a worker remembers (about 150 MB). A full memo forgets those met only once since
#: it was full last.
MEMO_WORDS = 3 << 18
#: Characters of texts that are split into words at a time.
CHUNK_CHARS = 4 << 20

#: Parts the words of a text, and begins a piece that no blank stands before.
#: A text that holds one of them is encoded whole.
_GAP, _CLOSE = "\x1e", "\x1f"
# Between a letter and punctuation a token ends; stems repeat, with what marks they may have behind.
_STEM = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])"

_WESTERN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]*")
# Python takes these for white space, the tokenizers do not.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
# White space with the word behind it. No token reaches over the end of a word.
_UNITS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")


def _bare_words(text: str) -> str | None:
    """Words, with gaps between them, of a tokenizer that drops white space; None if unsafe."""
    return None if _SEPARATORS.search(text) else _GAP.join(text.split())


def _spaced_words(text: str) -> str | None:
    """Words, with gaps between them, of a tokenizer that keeps white space; None if unsafe.

    A word stands for itself after a blank, or begins with its own white space.
    One line feed is put before the text; its id is the first and is dropped.
    """
    if not text.replace("\n", "").isprintable() and not text.translate(_PLAIN).isprintable():
        return None
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\t" in text or "\r" in text or text[-1] == " ":
        if text[0] in " \t\r\n":
            return None
        return "\n" + _GAP.join(u[1:] if u[0] == " " and u[1:2] not in _BLANKS else u for u in _UNITS.findall(text))
    return "\n" + text.replace(" ", _GAP).replace("\n", _GAP + "\n")


_PLAIN = str.maketrans("", "", "\t\r\n")
#: Letters from U+00C0 on by the names of their bytes.
_LATIN = {c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
#: What follows a lone blank that belongs to no word: other white space, or nothing.
_BLANKS = ("", " ", "\t", "\r", "\n")


class TokenIds:
    """Ids of texts under one tokenizer file.

    ``names_are_text``: whether the name of a special token in a text is spelt
    like other text; if not, it gives that token's id, as the library does unasked.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS, names_are_text: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_are_text
        # Texts with such a name are encoded whole.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.names = [t.content.strip() for t in added if not (names_are_text and t.special)]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        parts = [p["type"] for p in before.get("pretokenizers", [])]
        self.split: Callable[[str], str | None] = lambda text: None
        self.spaced = False
        if spec["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] \
                and not before["add_prefix_space"]:
            self.split, self.spaced = _spaced_words, True
        elif parts == ["Split", "ByteLevel"] and spec["model"].get("end_of_word_suffix") == "</w>":
            self.split = _bare_words
        # Such a name may arise only by the normalizer, or by words in a row.
        if any(t.normalized or re.search(r"\s", t.content) for t in added):
            self.split = lambda text: None
        self.before = len(self._whole(" x"))
        self.memo_words = memo_words
        self.memo: dict[str, int] = {}
        self.spare = 0, 0
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.again = np.zeros(1 << 12, bool)  # runs met again
        self.pool = np.zeros(1 << 14, np.uint32)
        self.runs = self.used = 0
        self._keep(np.zeros(0, np.uint32), np.zeros(1, np.int64))  # run 0 stands for no word

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _forget(self) -> None:
        """Keep the words met again since the last time, or none if they are too many."""
        met = self.again[:self.runs].tolist()
        words = [word for word, run in self.memo.items() if met[run]]
        if 4 * len(words) > 3 * self.memo_words:
            words = []
        runs = np.array([self.memo[word] for word in words], np.int64)
        ids, sizes = self._gather(runs), self.sizes[runs]
        self.runs, self.used = 1, 0
        self.again[:] = False
        self._keep(ids, sizes)
        self.memo = {word: run for run, word in enumerate(words, 1)}

    def _gather(self, runs: np.ndarray) -> np.ndarray:
        """Ids of runs in a row."""
        sizes = self.sizes[runs]
        after = np.cumsum(sizes)
        return self.pool[np.repeat(self.starts[runs] - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)]

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Add runs of ids, given in a row; the number of the first."""
        first, last = self.runs, self.runs + len(sizes)
        while last > len(self.starts):
            self.starts, self.sizes = (np.resize(a, 2 * len(a)) for a in (self.starts, self.sizes))
            self.again = np.concatenate([self.again, np.zeros(len(self.again), bool)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used:self.used + len(ids)] = ids
        self.again[first:last] = False
        self.starts[first:last], self.sizes[first:last] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(ids)
        self.runs = last
        return first

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row and their numbers.

        Plain words go to the library's model one by one, the others to the
        library as one text.
        """
        parts: list[list[int]] = []
        odd = []
        tokenize, blank = self.tokenizer.model.tokenize, "Ġ" if self.spaced else ""
        for k, word in enumerate(words):
            if word.isalpha() and (word.isascii() or _WESTERN.fullmatch(word)):
                piece = word if self.spaced else word.lower()
                parts.append([t.id for t in tokenize(blank + (piece if piece.isascii() else piece.translate(_LATIN)))])
            else:
                parts.append([])
                odd.append(k)
        if odd:
            ids, sizes = self._in_a_row([words[k] for k in odd])
            for k, own in zip(odd, np.split(ids, np.cumsum(sizes)[:-1])):
                parts[k] = own.tolist()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.fromiter(itertools.chain.from_iterable(parts), np.uint32, int(sizes.sum())), sizes

    def _in_a_row(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of any kind and their numbers."""
        real = [w if w[0] in " \t\r\n" else " x" + w[1:] if w[0] == _CLOSE else " " + w for w in words]
        lone = [k for k, w in enumerate(real) if w[-1] in " \t\r\n"]  # it could join what follows
        for k in lone:
            real[k] = " x"
        lengths = np.fromiter(map(len, real), np.int64, len(real))
        found = self.tokenizer.encode("".join(real), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        sizes = np.bincount(np.searchsorted(np.cumsum(lengths), starts, "right"), minlength=len(real))
        close = np.flatnonzero([w[0] == _CLOSE for w in words])
        if len(close):
            first = (np.cumsum(sizes) - sizes)[close]
            ids = np.delete(ids, (first[:, None] + np.arange(self.before)).reshape(-1))
            sizes[close] -= self.before
        if lone:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for k in lone:
                parts[k] = self._whole(words[k])
                sizes[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, sizes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has. Null has none."""
        parts: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, str, bool]] = []
        size = 0
        for k, text in enumerate(texts):
            for part, first in self._parts(text or ""):
                if waiting and size + len(part) > CHUNK_CHARS:
                    parts.append(self._encode(waiting, counts))
                    waiting, size = [], 0
                waiting.append((k, part, first))
                size += len(part)
        if waiting:
            parts.append(self._encode(waiting, counts))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), counts

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """A text's words with gaps between them, a very long text's in parts.

        The flag tells that an added line feed stands in front. An unsafe text
        is given whole behind a gap.
        """
        own = "" if not text else None if any(n in text for n in self.names) else self.split(text)
        if own is None:
            yield _GAP + text, False
            return
        at = 0
        while len(own) - at > CHUNK_CHARS:
            stop = own.find(_GAP, at + CHUNK_CHARS)
            if stop < 0:
                break
            yield own[at:stop], self.spaced and at == 0
            at = stop + 1
        yield own[at:], self.spaced and at == 0 and own != ""

    def _lookup(self, words: list[str]) -> np.ndarray:
        """Runs of words, of which each is given once."""
        memo = self.memo
        runs = np.array([memo.get(word, -1) if word else 0 for word in words], np.int64)
        self.again[runs[runs > 0]] = True
        self.spare = self.runs, self.used  # what lies behind is forgotten after this chunk
        fresh = np.flatnonzero(runs < 0).tolist()
        if fresh:
            room = max(0, self.memo_words - len(memo))
            ids, sizes = self._words([words[k] for k in fresh])
            first = self._keep(ids, sizes)
            runs[fresh] = first + np.arange(len(fresh))
            memo.update((words[k], first + n) for n, k in enumerate(fresh[:room]))
            self.spare = first + min(room, len(fresh)), self.spare[1] + int(sizes[:room].sum())
        return runs

    def _encode(self, parts: list[tuple[int, str, bool]], counts: np.ndarray) -> np.ndarray:
        """Ids of parts of texts; adds their numbers to ``counts``."""
        if len(self.memo) >= self.memo_words:
            self._forget()
        whole = [k for k, (_, part, _) in enumerate(parts) if part.startswith(_GAP)]
        texts = ["" if part.startswith(_GAP) else part for _, part, _ in parts]
        stems = pc.replace_substring_regex(pa.array(texts, pa.large_string()), _STEM, rf"\1{_GAP}{_CLOSE}\2")
        split = pc.split_pattern(stems, _GAP)
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        runs = self._lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        for k in whole:  # not remembered
            ids = self._whole(parts[k][1][1:])
            runs[ends[k]] = self._keep(ids, np.array([len(ids)]))
        ids = self._gather(runs)
        after = np.concatenate([[0], np.cumsum(self.sizes[runs])])
        sizes = np.diff(after[ends])
        led = np.array([first for _, _, first in parts])
        if led.any():
            keep = np.ones(len(ids), bool)
            keep[after[ends[:-1]][led]] = False
            ids, sizes = ids[keep], sizes - led
        np.add.at(counts, [k for k, _, _ in parts], sizes)
        self.runs, self.used = self.spare
        return ids


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The worker's encoder of a tokenizer file, read once."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path, names_are_text=False)
    return _LOADED[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` after each text, and the counts with it."""
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1
