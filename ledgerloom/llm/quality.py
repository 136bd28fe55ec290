"""Quality rules: how far a document's characters and common words lie from the languages of the corpus.

References are counted over the whole table: for each language its characters by
class and its common words (at least ``word_share`` of the language's words). A
document's two histograms are compared with every reference by Jensen-Shannon
divergence (base 2); the nearest language counts. A document fails if either
divergence is over its threshold, which is widened for short texts, where a
histogram is noisy; texts of fewer than ``min_words`` words are not judged this way.
Simple counts (repeated lines, repeated 8-word windows, symbols) come along.

Every language of ``enough`` words or more has a reference, however small its share of
the table; 1 / word_share words of each at most reach the driver and tasks. Documents
of a language with fewer words are measured against the others, but do not fail by
divergence.

Defined cases: a null or empty text has zero counts and fails the base rule of 20
words; a null lang teaches nothing; without any reference nothing is judged by
divergence; rows without doc_id and repeated rows are judged one by one. Columns
other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import drop, kept, mapped, passes, text_bytes
from ledgerloom.llm.words import letter_gaps, prefix_sums, spans_hash, windows, word_spans

CLASSES = ("lower", "upper", "digit", "blank", "newline", "mark", "symbol", "other")
SYMBOLS = b"#*$%&|<>"
#: Words that a task counts before it passes the counts on.
BLOCK_WORDS = 2_000_000
#: Cells (documents x vocabulary) of one block of histograms.
BLOCK_CELLS = 1 << 22


class References(NamedTuple):
    langs: list[str]
    chars: np.ndarray  # (languages, classes): shares
    vocabulary: np.ndarray  # sorted hashes of words that are common in any language
    words: list  # for each language its places in the vocabulary (the last: all other words) and their shares


def class_of_byte() -> np.ndarray:
    """Class of each byte; len(CLASSES) for bytes that continue a character."""
    t = np.full(256, CLASSES.index("symbol"), np.int64)
    t[97:123], t[65:91], t[48:58] = 0, 1, 2
    t[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], t[0x0A] = 3, 4
    t[list(b".,;:!?'\"()-")] = CLASSES.index("mark")
    t[128:192], t[192:] = len(CLASSES), CLASSES.index("other")
    return t


def class_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, classes)."""
    n, k = len(offsets) - 1, len(CLASSES) + 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(doc * k + class_of_byte()[raw], minlength=n * k).reshape(n, k)[:, :-1]


def lower_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of letters and digits, A-Z lower-cased, and how many precede each document."""
    starts, ends, at = word_spans(raw, offsets, letter_gaps())
    return spans_hash(prefix_sums(raw, lower=True), starts, ends), at


def references(docs: DataFrame, word_share: float = 0.005, lang_share: float | None = None, enough: int = 2000) -> References:
    """Count the corpus: one pass, pre-aggregated in each task.

    ``enough``: words that a language must have for a reference; with 2,000 a common word
    occurs ten times at least. ``lang_share``, if given, asks for that share of all words instead.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names, held = [], [], 0
        chars: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            all_names, all_hashes = np.concatenate(names or [np.zeros(0, object)]), np.concatenate(hashes or [np.zeros(0, np.uint64)])
            langs, hs, ns = [], [], []
            for lang in sorted(chars):
                u, n = np.unique(all_hashes[all_names == lang], return_counts=True)
                langs += [lang] * (len(u) + len(CLASSES))
                hs += [u.view(np.int64), np.arange(len(CLASSES))]
                ns += [n, chars[lang]]
            kinds = np.concatenate([x for a in hs[::2] for x in (np.zeros(len(a), bool), np.ones(len(CLASSES), bool))] or [np.zeros(0, bool)])
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "is_char": kinds, "item": np.concatenate([*hs, np.zeros(0, np.int64)]), "n": np.concatenate([*ns, np.zeros(0, np.int64)]).astype(np.int64)})
            hashes.clear(), names.clear(), chars.clear()
            held = 0

        for batch in batches:
            for part in passes(batch):
                raw, off = text_bytes(part.column(0))
                h, at = lower_words(raw, off)
                lang = np.array(part.column(1).to_pylist(), object)
                by_class = class_counts(raw, off)
                for name in set(lang.tolist()):
                    chars[name] = chars.get(name, 0) + by_class[lang == name].sum(0)
                hashes.append(h)
                names.append(np.repeat(lang, np.diff(at)))
                held += len(h)
                if held >= BLOCK_WORDS:
                    yield from flush()
        if chars:
            yield from flush()

    rows = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = rows.mapInArrow(count, "lang string, is_char boolean, item long, n long").groupBy("lang", "is_char", "item").agg(F.sum("n").alias("n"))
    # Two reads of the counts: the totals, then what is common. They are written so that the texts are counted once.
    counted, path = kept(counted, "counts")
    totals = counted.filter("not is_char").groupBy("lang").agg(F.sum("n").alias("words"))
    least = enough if lang_share is None else lang_share * (totals.agg(F.sum("words")).first()[0] or 0)
    totals = totals.filter(F.col("words") >= max(1, least))
    large = {r.lang: r.words for r in totals.collect()}
    common = counted.join(F.broadcast(totals), "lang").filter(F.col("is_char") | (F.col("n") >= F.col("words") * F.lit(word_share))).select("lang", "is_char", "item", "n").collect()
    drop(docs.sparkSession, path)
    langs = sorted(large)
    words = {r["item"] for r in common if not r.is_char}
    vocabulary = np.sort(np.array(sorted(words), np.int64).view(np.uint64)) if words else np.zeros(0, np.uint64)
    char_n, word_n = np.zeros((len(langs), len(CLASSES))), {lang: {} for lang in langs}
    number = {lang: i for i, lang in enumerate(langs)}
    for r in common:
        if r.is_char:
            char_n[number[r.lang], r["item"]] = r.n
        else:
            word_n[r.lang][int(np.searchsorted(vocabulary, np.array([r["item"]], np.int64).view(np.uint64)[0]))] = r.n
    by_word = []
    for lang in langs:
        rest = large[lang] - sum(word_n[lang].values())
        n = word_n[lang] | ({len(vocabulary): rest} if rest else {})
        by_word.append((np.array(sorted(n), np.int64), np.array([n[k] for k in sorted(n)], float) / large[lang]))
    return References(langs, char_n / np.maximum(char_n.sum(1, keepdims=True), 1), vocabulary, by_word)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence, base 2, of every row of ``p`` from every row of ``q``."""
    out = np.zeros((len(p), len(q)))
    for j, row in enumerate(q):
        m = (p + row) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
            right = np.where(row > 0, row * np.log2(row / m), 0).sum(1)
        out[:, j] = (left + right) / 2
    return np.clip(out, 0, 1)


def word_divergence(p: np.ndarray, refs: list) -> np.ndarray:
    """:func:`divergence` from rows that are given by their places above 0: elsewhere a share of ``p`` adds half of itself."""
    out, total = np.zeros((len(p), len(refs))), p.sum(1)
    for j, (at, row) in enumerate(refs):
        own = p[:, at]
        m = (own + row) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            both = np.where(own > 0, own * np.log2(own / m), 0) + row * np.log2(row / m)
        out[:, j] = (total + row.sum() + (both - own - row).sum(1)) / 2
    return np.clip(out, 0, 1)


def base_counts(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document."""
    n = len(offsets) - 1
    starts, ends, at = word_spans(raw, offsets)
    sums = prefix_sums(raw)
    per_doc = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    blank = np.zeros(256, bool)
    blank[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    blank[128:192] = True
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    bounds = np.unique(np.concatenate([offsets, np.flatnonzero(raw == 10) + 1]))
    first, last = bounds[:-1], bounds[1:]
    filled = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[filled], last[filled]
    last = last - (raw[last - 1] == 10)
    doc = np.searchsorted(offsets, first, "right") - 1
    lines = np.stack([doc.astype(np.uint64), spans_hash(sums, first, last)], 1)
    distinct = np.unique(lines, axis=0)[:, 0].astype(np.int64) if len(lines) else np.zeros(0, np.int64)
    dup_lines = np.bincount(doc, minlength=n) - np.bincount(distinct, minlength=n)
    hashes = spans_hash(sums, starts, ends)
    window, word = windows(hashes, at, 8)
    doc = np.searchsorted(at, word, "right") - 1
    order = np.lexsort((window, doc))
    w, d = window[order], doc[order]
    same = (w[1:] == w[:-1]) & (d[1:] == d[:-1])
    again = np.zeros(len(w), bool)
    again[1:] |= same
    again[:-1] |= same
    edge = np.zeros(len(starts) + 9, np.int64)
    hit = word[order][again]
    edge[hit] += 1
    edge[hit + 8] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[: len(starts)] > 0)])
    return {"n_words": np.diff(at), "word_chars": per_doc(~blank[raw]), "n_symbols": per_doc(symbol[raw]), "n_dup_lines": dup_lines, "n_repeat_words": np.diff(covered[at])}


def histograms(raw: np.ndarray, offsets: np.ndarray, refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of character classes and common words of each document, and its number of lower-cased words."""
    n, v = len(offsets) - 1, len(refs.vocabulary)
    chars = class_counts(raw, offsets).astype(float)
    h, at = lower_words(raw, offsets)
    place = np.full(len(h), v, np.int64)
    if v:
        found = np.minimum(np.searchsorted(refs.vocabulary, h), v - 1)
        place = np.where(refs.vocabulary[found] == h, found, v)
    doc = np.repeat(np.arange(n), np.diff(at))
    word = np.bincount(doc * (v + 1) + place, minlength=n * (v + 1)).reshape(n, v + 1).astype(float)
    share = lambda x: x / np.maximum(x.sum(1, keepdims=True), 1)
    return share(chars), share(word), np.diff(at)


def judge(docs: DataFrame, refs: References, max_char: float = 0.04, max_word: float = 0.10, char_slack: float = 3.0, word_slack: float = 5.0, min_words: int = 50) -> DataFrame:
    """Counts, divergences from the nearest language and the verdict for every row.

    Each threshold is widened by its slack / words of the text. A text whose lang has no reference does not fail by divergence.
    """

    known = set(refs.langs)

    def work(part: pa.RecordBatch) -> dict:
        raw, off = text_bytes(part.column(1))
        out = base_counts(raw, off)
        out["base_failed"] = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
        n = part.num_rows
        char_js, word_js, lang, far = np.zeros(n), np.zeros(n), np.full(n, None, object), np.zeros(n, bool)
        if refs.langs:
            by_char, by_word, count = np.zeros((n, len(refs.langs))), np.zeros((n, len(refs.langs))), np.zeros(n, np.int64)
            step = max(1, BLOCK_CELLS // (len(refs.vocabulary) + 1))
            for a in range(0, n, step):
                b = min(n, a + step)
                chars, words, count[a:b] = histograms(raw[off[a] : off[b]], off[a : b + 1] - off[a], refs)
                by_char[a:b], by_word[a:b] = divergence(chars, refs.chars), word_divergence(words, refs.words)
            near = (by_char + by_word).argmin(1)
            char_js, word_js = by_char[np.arange(n), near], by_word[np.arange(n), near]
            lang = np.array(refs.langs, object)[near]
            per = 1 / np.maximum(count, 1)
            rare = np.array([x is not None and x not in known for x in part.column(2).to_pylist()], bool)
            far = ~rare & (out["n_words"] >= min_words) & ((char_js > max_char + char_slack * per) | (word_js > max_word + word_slack * per))
        return {"doc_id": part.column(0), **out, "char_js": char_js, "word_js": word_js, "nearest": lang, "kept": ~out["base_failed"] & ~far}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return mapped(rows, work, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_js double, word_js double, nearest string, kept boolean")
