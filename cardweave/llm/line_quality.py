"""Line-first quality rules.

Every line with a word is judged by punctuation, navigation and boilerplate rules,
in any script: marks are those of Unicode, and where words are not parted by blanks
they are told by the number of letters. A short line without a mark may be a heading
and counts as navigation only among others. Lines that fail are removed, and a document that loses too
much of its text that way is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cardweave.llm.store import shipped, slices
from cardweave.llm.text_stats import SPACE, SYMBOLS, repeated_lines, repeated_words


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the rules; shares are of a line's characters without white space."""

    #: Base: fewest words, and the largest percentage of words in repeated windows.
    words: int = 10
    repeated_percent: int = 20
    #: Punctuation: a line fails with this many marks or more that are over this
    #: percentage of it, or with this many words and no sentence mark at all.
    marks: int = 4
    marks_percent: int = 15
    unpunctuated_words: int = 40
    #: Navigation: separators in a line, and words to each of them at most; and words
    #: of an entry without any punctuation, and entries in a row that make a menu.
    separators: int = 3
    words_to_separator: int = 5
    entry_words: int = 3
    entries: int = 3
    #: Percentage of a document's characters whose loss rejects it.
    lost_percent: int = 50


_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_SEPARATORS = re.compile(r"[|»›•·]|(?<=\s)>(?=\s)")
_MARK = regex.compile(r"\p{P}|[|<>$+=^`~]")
# Letters of scripts without blanks between words, by the letters that usually make a word.
_UNPARTED = [(regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]"), 2),
             (regex.compile(r"[\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"), 4)]
_NO_SENTENCE_MARKS = regex.compile(r"[\p{Thai}\p{Lao}]")
_SENTENCE = re.compile(r"[.!?:;…。！？：；．।॥؟؛۔։።፧។៕။‽]")
# Phrases of lines that belong to a site or a file, not to its text.
_BOILERPLATE = re.compile(
    r"\b(?:all rights reserved|copyright (?:\(c\)|©|\d{4})|licensed under|terms of (?:use|service)|privacy policy"
    r"|cookies? (?:policy|settings)|(?:uses?|accept(?: all)?) cookies|(?:enable|requires?) javascript"
    r"|subscribe to our|sign up for|click here|read more|share (?:this|on)|follow us|lorem ipsum"
    r"|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|hier klicken|mehr lesen|folgen sie uns"
    r"|tous droits réservés|politique de confidentialité|mentions légales|cliquez ici|lire la suite|suivez-nous"
    r"|todos los derechos reservados|política de privacidad|aviso legal|haga clic aquí|leer más|síguenos)\b|^©"
    r"|無断転載|利用規約|プライバシーポリシー|版权所有|隐私政策|使用条款|보유\. 무단|개인정보처리방침",
    re.IGNORECASE)
_NAVIGATION = re.compile(
    r"^(?:home|menu|next|previous|back to top|skip to content|log ?in|sign ?in|register|search|contact|about us"
    r"|startseite|kontakt|anmelden|suche|accueil|connexion|recherche|inicio|contacto|buscar)\W*$",
    re.IGNORECASE)

ENTRY = "entry"


def line_fails(line: str, rules: LineRules) -> str | None:
    """The kind of rule that a line with a word fails, or None; ``ENTRY`` where that hangs on its neighbours."""
    data = line.encode("utf-8", "surrogatepass")
    words = len(data.split())
    spoken = True
    if len(data) == len(line):
        solid = len(data.translate(None, SPACE))
        marks = len(data) - len(data.translate(None, _MARKS))
    else:
        solid = len(line) - sum(map(line.count, " \t\v\f\r"))
        marks = len(_MARK.findall(line))
        if not line.isascii() and max(line) > "\u0dff":  # none of these scripts lies before
            for letters, size in _UNPARTED:
                words += max(0, -(-len(letters.findall(line)) // size) - 1)
            spoken = 2 * len(_NO_SENTENCE_MARKS.findall(line)) < solid
    separators = len(_SEPARATORS.findall(line))
    if separators >= rules.separators and words <= separators * rules.words_to_separator or _NAVIGATION.search(line.strip()):
        return "navigation"
    if marks >= rules.marks and 100 * marks > rules.marks_percent * solid \
            or spoken and words >= rules.unpunctuated_words and not _SENTENCE.search(line):
        return "punctuation"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    return ENTRY if words <= rules.entry_words and not marks else None


def failing_lines(lines: list[str], rules: LineRules) -> list[bool]:
    """Which lines fail. An entry does in a row of ``rules.entries`` lines that are entries or navigation."""
    kinds = [line_fails(line, rules) if line.strip(" \t\v\f\r") else "" for line in lines]
    fails = [kind not in ("", ENTRY, None) for kind in kinds]
    run: list[int] = []
    for k, kind in enumerate([*kinds, None]):
        if kind in (ENTRY, "navigation"):
            run.append(k)
        elif kind != "":  # blank lines do not end a menu
            if len(run) >= rules.entries:
                for at in run:
                    fails[at] = True
            run = []
    return fails


def judge(text: str | None, rules: LineRules) -> dict:
    """Base counts, verdict and cleaned text of one document."""
    whole = text or ""
    data = whole.encode("utf-8", "surrogatepass")
    words = data.split()
    repeated = repeated_words(words)
    word_chars = len(whole) - (len(data) - len(data.translate(None, SPACE)))
    failed = len(words) < rules.words or 100 * repeated > rules.repeated_percent * len(words)
    kept, lost, n_lines, n_failed = [], 0, 0, 0
    lines = whole.split("\n")
    for line, fails in zip(lines, failing_lines(lines, rules)):
        n_lines += bool(line.strip(" \t\v\f\r"))
        if fails:
            n_failed += 1
            lost += len(line) - sum(map(line.count, " \t\v\f\r"))
        else:
            kept.append(line)
    return {"n_words": len(words), "word_chars": word_chars,
            "n_symbols": len(data) - len(data.translate(None, SYMBOLS)), "n_dup_lines": repeated_lines(whole),
            "n_repeat_words": repeated, "base_failed": failed,
            "kept": not failed and 100 * lost <= rules.lost_percent * word_chars,
            "n_lines": n_lines, "n_failed_lines": n_failed, "lost_chars": lost,
            "cleaned": None if text is None else whole if not n_failed else "\n".join(kept)}


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
           ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines", pa.int64()),
           ("n_failed_lines", pa.int64()), ("lost_chars", pa.int64()), ("cleaned", pa.string())]


def _judging(rules: LineRules, fields: list) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [judge(t.as_py(), rules) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array([x[name] for x in found], kind) for name, kind in fields)],
                names=[*batch.schema.names[1:], *(name for name, _ in fields)])
    return run


def judge_documents(docs: DataFrame, rules: LineRules = LineRules(), *, doc_id: str = "doc_id", text: str = "text",
                    cleaned: bool = True) -> DataFrame:
    """(doc_id, counts, base_failed, kept, line counts, cleaned text) of every row; no shuffle.

    ``cleaned`` is the text without its failing lines, as the kept documents
    have it; blank lines stay. Null and empty texts have no words, fail the base
    rules and stay what they are. Repeated rows and null ids give a row each.
    Other columns are ignored.
    """
    fields = _FIELDS if cleaned else _FIELDS[:-1]
    kinds = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    return shipped(rows).mapInArrow(_judging(rules, fields),
                                    "doc_id long, " + ", ".join(f"{n} {kinds[k]}" for n, k in fields))
