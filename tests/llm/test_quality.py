import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import quality
from tests.llm.test_words import WORD


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def histogram(text, vocabulary=None):
    """Shares of character classes, and of common words and all others."""
    text = text or ""
    kinds = Counter()
    for c in text:
        kind = "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "newline" if c == "\n" else "blank" if c in " \t\x0b\x0c\r" else "mark" if c in ".,;:!?'\"()-" else "other" if ord(c) > 127 else "symbol"
        kinds[kind] += 1
    tokens = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text)
    return kinds, Counter("".join(c.lower() if c.isascii() else c for c in t) for t in tokens)


def js(p, q):
    m = (p + q) / 2
    kl = lambda a: float(sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0))
    return (kl(p) + kl(q)) / 2


def test_counts_and_divergences_against_brute_force(edge_docs, edge_rows):
    refs = quality.references(edge_docs, word_share=0.01, lang_share=1e-6)
    by_lang = {}
    for _, text, lang, *_ in edge_rows:
        if text is not None and lang is not None:
            kinds, tokens = by_lang.setdefault(lang, (Counter(), Counter()))
            k, t = histogram(text)
            kinds.update(k)
            tokens.update(t)
    assert refs.langs == sorted(by_lang)
    common = sorted({t for _, tokens in by_lang.values() for t, n in tokens.items() if n >= 0.01 * tokens.total()})
    assert len(refs.vocabulary) == len(common)
    shares = lambda c, names: np.array([c[n] for n in names], float) / max(1, c.total())
    # A word's count is known for languages in which it is common; the rest counts as other words.
    word_refs = {}
    for lang, (_, tokens) in by_lang.items():
        own = Counter({t: n for t, n in tokens.items() if n >= 0.01 * tokens.total()})
        word_refs[lang] = np.append(shares(own, common) * own.total() / tokens.total(), 1 - own.total() / tokens.total())
    got = sorted(quality.judge(edge_docs, refs).collect(), key=lambda r: str((r.doc_id, r.n_words, r.word_chars, r.char_js)))
    expected = []
    for doc_id, text, *_ in edge_rows:
        kinds, tokens = histogram(text)
        p = shares(kinds, quality.CLASSES)
        q = np.append(shares(tokens, common), 0)
        q[-1] = 1 - q.sum() if tokens else 0
        dist = {lang: (js(p, shares(by_lang[lang][0], quality.CLASSES)), js(q, word_refs[lang])) for lang in sorted(by_lang)}
        near = min(dist, key=lambda x: sum(dist[x]))
        char_js, word_js = dist[near]
        n = max(1, tokens.total())
        base = brute(text)
        far = base[0] >= 50 and (char_js > 0.04 + 3 / n or word_js > 0.10 + 5 / n)
        expected.append((doc_id, *base, char_js, word_js, near, not base[-1] and not far))
    expected.sort(key=lambda r: str((r[0], r[1], r[2], r[7])))
    for r, e in zip(got, expected, strict=True):
        assert tuple(r)[:7] == e[:7]
        assert r.char_js == pytest.approx(e[7], abs=1e-9) and r.word_js == pytest.approx(e[8], abs=1e-9)
        assert (r.nearest, r.kept) == e[9:]


def test_whole_table(table):
    docs = table("documents")
    got = {r.doc_id: r for r in quality.judge(docs, quality.references(docs)).collect()}
    for d in docs.collect():
        assert tuple(got[d.doc_id])[1:7] == brute(d.text)


def test_plain_prose_is_kept_and_junk_is_not(table):
    docs = table("documents", "sf0.01")
    judged = quality.judge(docs, quality.references(docs)).join(table("labels", "sf0.01"), "doc_id").filter("not base_failed and n_words >= 50").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.75


def test_without_references_only_the_base_rules_hold(edge_docs, no_docs):
    refs = quality.references(no_docs)
    assert refs.langs == [] and quality.judge(no_docs, refs).count() == 0
    assert all(r.kept == (not r.base_failed) for r in quality.judge(edge_docs, refs).collect())


def test_documents_of_rare_languages_are_kept(spark):
    """A language with 0.06 % of all words has a reference of its own; one with too few words does not fail for that."""
    rng = np.random.default_rng(4)
    def text(mark, n):
        return " ".join(f"{mark}{k}" for k in np.minimum(rng.zipf(1.3, n), 400))
    rows = [(i, text("a", 1_000_000), "en") for i in range(4)] + [(10 + i, text("b", 80), "rare") for i in range(30)] + [(50, text("c", 80), "few"), (51, text("c", 80), "en"), (52, text("c", 80), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality.references(docs)
    got = {r.doc_id: r for r in quality.judge(docs, refs).collect()}
    assert refs.langs == ["en", "rare"] and not any(r.base_failed for r in got.values())
    assert all(got[10 + i].kept and got[10 + i].nearest == "rare" for i in range(30))
    assert got[50].kept and not got[51].kept and not got[52].kept
    # What else is in the table changes nothing about the language's own reference.
    alone = quality.references(docs.filter("lang = 'rare'"))
    assert np.array_equal(alone.chars[0], refs.chars[1]) and np.array_equal(np.sort(alone.words[0][1]), np.sort(refs.words[1][1]))
