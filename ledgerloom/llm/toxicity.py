"""Toxicity: a convolutional text classifier trained in numpy.

A token (run of letters and digits, A-Z lower-cased) has the sum of three hashed
embeddings: of the word, its first four bytes and its first six, so that inflected
forms share what they learn. Filters of widths 1 to 3 run over the whole text and
are max-pooled; one linear layer gives the logit. A small naive-Bayes table guesses
the language from the words, and the logit is shifted by the threshold that
separates held-back training texts of that language best.

Training takes a bounded sample of labelled rows (``per_class`` rows of each label
and texts of at most ``max_chars`` characters, by smallest hash), so its cost and
the model's size are the same for any table. Scoring reads every whole text.

Defined cases: a null or empty text has the score of a text without tokens; rows
without doc_id are scored and counted as held out; repeated rows are scored one by
one; labels without doc_id or toxic teach nothing; without labels of both kinds
every score is the share of toxic labels (0 if there are none). Columns other than
doc_id, text (and, to learn from, lang) are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import kept, mapped, passes, text_bytes
from ledgerloom.llm.words import letter_gaps, prefix_sums, spans_hash, word_spans

BUCKETS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 15, 8, 12, (1, 2, 3), (4, 6)
PAD = max(WIDTHS) - 1


class Model(NamedTuple):
    tables: list  # one of embeddings for words and for each prefix; the last row is padding
    filters: list  # by width: (width, dim, filters)
    bias: list
    out: np.ndarray
    out_bias: float
    languages: np.ndarray  # (buckets, languages): log share of a word; empty if none was learned
    thresholds: np.ndarray  # by language, or one
    constant: float | None  # a model that could not be trained


def held_out(doc_id: Column) -> Column:
    """True for rows that must not teach: crc32 of the id as text divisible by 5, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (tokens x tables) with PAD rows of padding after each text, and the rows before each text.

    A text without tokens has one more row of padding.
    """
    starts, ends, at = word_spans(raw, offsets, letter_gaps())
    sums = prefix_sums(raw, lower=True)
    found = np.stack([spans_hash(sums, starts, e) for e in [ends, *(np.minimum(ends, starts + p) for p in PREFIXES)]], 1) % np.uint64(BUCKETS)
    count = np.diff(at)
    rows = np.concatenate([[0], np.cumsum(np.maximum(count, 1) + PAD)])
    out = np.full((rows[-1], 1 + len(PREFIXES)), BUCKETS, np.int64)
    out[np.arange(len(starts)) + np.repeat(rows[:-1] - at[:-1], count)] = found
    return out, rows


def _embed(m: Model, ids: np.ndarray) -> np.ndarray:
    x = m.tables[0][ids[:, 0]]
    for k in range(1, len(m.tables)):
        x += m.tables[k][ids[:, k]]
    return x


def _convolved(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A row for each row of ``x``; the last width - 1 rows lack what would follow them and are never used."""
    y = x @ w[0]
    for j in range(1, len(w)):
        y[:-j] += x[j:] @ w[j]
    return y


def _positions(rows: np.ndarray) -> np.ndarray:
    """Start and end of each text's windows, one after another, for reduceat."""
    return np.stack([rows[:-1], rows[1:] - PAD], 1).ravel()


def logits(m: Model, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    x, out = _embed(m, ids), np.full(len(rows) - 1, m.out_bias, np.float32)
    for i, w in enumerate(m.filters):
        pooled = np.maximum.reduceat(_convolved(x, w), _positions(rows), axis=0)[::2]
        out += np.maximum(pooled + m.bias[i], 0) @ m.out[i]
    return out


def language_of(m: Model, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    if m.languages.shape[1] < 2:
        return np.zeros(len(rows) - 1, np.int64)
    return np.add.reduceat(m.languages[ids[:, 0]], rows[:-1], axis=0).argmax(1)


def _warm(ids: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Small random embeddings whose first value says how far a bucket leans to either label."""
    out = []
    for k in range(1 + len(PREFIXES)):
        pos, neg = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        for t, label in zip(ids, y, strict=True):
            (pos if label else neg)[np.unique(t[:, k])] += 1
        share, n = y.mean(), pos + neg
        lean = (pos - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share) + 1)
        table = rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32)
        table[:, 0] += np.clip(lean, -6, 6) / 6
        table[BUCKETS] = 0
        out.append(table)
    return out


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], epochs: int = 8, batch: int = 32, rate: float = 0.05, seed: int = 7) -> Model:
    """Train on the texts; every fifth by hash is kept back for the thresholds."""
    y = np.asarray(labels, np.int64)
    if y.sum() in (0, len(y)):
        return Model([], [], [], np.zeros(0), 0.0, np.zeros((0, 0)), np.zeros(1), float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    ids, rows = tokens(*text_bytes(pa.array(texts, pa.string())))
    each = [ids[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)]
    back = np.array([zlib.crc32(f"{t} ".encode()) % 5 == 0 for t in texts])
    if not 0 < y[~back].sum() < (~back).sum():
        back[:] = False
    train = np.flatnonzero(~back)
    tables = _warm([each[i] for i in train], y[train], rng)
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[0, 0] += 1
    m = Model(tables, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full((len(WIDTHS), FILTERS), 0.1, np.float32), -1.0, np.zeros((0, 0)), np.zeros(1), None)
    weight = np.where(y == 1, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean()))
    seen = [np.full(t.shape[0], 1e-2, np.float32) for t in m.tables]
    dense = [*m.filters, *m.bias, m.out]
    moved = [np.full_like(p, 1e-2) for p in dense]
    bias, bias_moved = m.out_bias, 1e-2
    for _ in range(epochs):
        order = rng.permutation(train)
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            at = np.concatenate([[0], np.cumsum([len(each[i]) for i in some])])
            part = np.concatenate([each[i] for i in some])
            x = _embed(m, part)
            score, kept = np.full(len(some), bias, np.float32), []
            for i, w in enumerate(m.filters):
                c = _convolved(x, w)
                best = np.stack([s + c[s : e - PAD].argmax(0) for s, e in zip(at[:-1], at[1:], strict=True)])
                h = np.maximum(np.take_along_axis(c, best, 0) + m.bias[i], 0)
                score += h @ m.out[i]
                kept.append((best, h))
            wrong = ((1 / (1 + np.exp(-score)) - y[some]) * weight[some] / len(some)).astype(np.float32)
            grads, touched, flows = [np.zeros_like(p) for p in dense], [], []
            for i, (w, (best, h)) in enumerate(zip(m.filters, kept, strict=True)):
                back_h = wrong[:, None] * m.out[i] * (h > 0)
                grads[len(WIDTHS) + i] += back_h.sum(0)
                grads[-1][i] += wrong @ h
                for j in range(len(w)):
                    grads[i][j] += np.einsum("bkd,bk->dk", x[best + j], back_h)
                    touched.append((best + j).ravel())
                    flows.append((back_h[:, :, None] * w[j].T[None]).reshape(-1, DIM))
            where, flow = np.concatenate(touched), np.concatenate(flows)
            for k, table in enumerate(m.tables):
                bucket, inverse = np.unique(part[where, k], return_inverse=True)
                g = np.zeros((len(bucket), DIM), np.float32)
                np.add.at(g, inverse, flow)
                g[bucket == BUCKETS] = 0
                seen[k][bucket] += (g * g).mean(1)
                table[bucket] -= rate * g / np.sqrt(seen[k][bucket])[:, None]
            for p, g, s in zip(dense, grads, moved, strict=True):
                s += g * g
                p -= rate * g / np.sqrt(s)
            g = float(wrong.sum())
            bias_moved += g * g
            bias -= rate * g / bias_moved**0.5
    m = m._replace(out_bias=float(bias), languages=_languages(each, langs))
    judged = back if back.any() else np.ones(len(y), bool)
    z, lang = logits(m, ids, rows), language_of(m, ids, rows)
    overall = _threshold(z[judged], y[judged])
    by_lang = [_threshold(z[own], y[own]) if min(y[own := judged & (lang == n)].sum(), (1 - y[own]).sum()) >= 10 else overall for n in range(max(1, m.languages.shape[1]))]
    return m._replace(thresholds=np.array(by_lang, np.float32))


def _threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap that separates the labels with the best F1."""
    if not 0 < y.sum() < len(y):
        return 0.0
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    following = z[order[best + 1]] if best + 1 < len(y) else z[order[best]] - 1
    return float((z[order[best]] + following) / 2)


def _languages(each: list[np.ndarray], langs: list[str | None]) -> np.ndarray:
    names = sorted({x for x in langs if x is not None})
    counts = np.full((BUCKETS + 1, len(names)), 0.1)
    for t, name in zip(each, langs, strict=True):
        if name is not None:
            np.add.at(counts[:, names.index(name)], t[:, 0], 1)
    logs = np.log(counts / counts.sum(0))
    logs[BUCKETS] = 0
    return logs.astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> DataFrame:
    """text, toxic and lang of the bounded sample: of each label the rows with the least hashes."""
    rows = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    texts = docs.select("doc_id", "text", "lang").filter(F.length("text").between(1, max_chars))
    # Only labels whose document can be used are ranked; the texts themselves stay where they are.
    usable, _ = kept(rows.join(texts.select("doc_id"), "doc_id", "left_semi"), "usable")

    def least(df: DataFrame) -> DataFrame:
        """Each task keeps the first ``per_class`` of a label before they meet."""
        first = [df.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for label in (0, 1)]
        return first[0].unionByName(first[1])

    # A document may have several rows: rank again.
    some, _ = kept(texts.join(F.broadcast(least(usable)), "doc_id"), "sample")
    return least(some).select("text", "toxic", "lang")


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 20_000) -> Model:
    """Fit on the bounded sample, on the driver."""
    rows = sorted(training_rows(docs, labels, per_class, max_chars).collect(), key=lambda r: (zlib.crc32(r.text.encode()), r.text, r.toxic, r.lang or ""))
    return fit([r.text for r in rows], np.array([r.toxic for r in rows], np.int64), [r.lang for r in rows])


def probabilities(m: Model, texts: pa.Array) -> np.ndarray:
    """0 to 1 for each text; 0.5 at the threshold of its language."""
    if m.constant is not None:
        return np.full(len(texts), m.constant)
    ids, rows = tokens(*text_bytes(texts))
    z = logits(m, ids, rows) - m.thresholds[language_of(m, ids, rows)]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""

    def work(part: pa.RecordBatch) -> dict:
        p = probabilities(model, part.column(1))
        return {"doc_id": part.column(0), "held_out": part.column(2), "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return mapped(rows, work, "doc_id long, held_out boolean, score double, predicted int")


def remove(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                yield part.filter(pa.array(probabilities(model, part.column(at)) < 0.5))

    return docs.mapInArrow(work, docs.schema)
