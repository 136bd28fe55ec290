import random
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa

from ledgerloom.llm import paragraph_dedup
from ledgerloom.llm.paragraph_dedup import Settings
from ledgerloom.llm.shared import drop, kept, release, text_bytes
from tests.llm.test_near_dedup import reach
from tests.llm.test_words import WORD, fold

S = Settings()


def cut(text):
    """The paragraphs' words, by the operator's own division, which the other tests look at."""
    raw, off = text_bytes(pa.array([text]))
    w, first, _ = paragraph_dedup.paragraphs(raw, off, S.reach)
    return [[raw[a:b].tobytes().decode() for a, b in zip(w.starts[x:y], w.ends[x:y], strict=True)] for x, y in zip(first[:-1], first[1:], strict=True)]


def brute(rows):
    """All pairs of paragraphs by exact Jaccard, components, runs: doc_id -> (paragraphs, repeated, removed, removed words)."""
    units = {}
    for n, (doc_id, text, *_) in enumerate(rows):
        if doc_id is not None and text:
            for pos, w in enumerate(cut(text)):
                low = [fold(x) for x in w]
                units[n, pos] = (len(w), frozenset(tuple(low[i : i + 5]) for i in range(max(1, len(low) - 4))))
    long = {k: s for k, (n, s) in units.items() if n >= S.min_words}
    holders = defaultdict(list)
    for k, s in long.items():
        holders[s].append(k)
    edges = [(v[0], k) for v in holders.values() for k in v[1:]]
    distinct = list(holders)
    edges += [(holders[x][0], holders[y][0]) for i, x in enumerate(distinct) for y in distinct[:i] if 100 * len(x & y) >= 75 * len(x | y)]
    home = reach(edges, long)
    groups = defaultdict(list)
    for k, h in home.items():
        groups[h].append(k)
    repeated = {k for g in groups.values() if len({rows[n][0] for n, _ in g}) > 1 for k in g}
    first = {k: min(g, key=lambda x: (rows[x[0]][0], x[1])) for g in groups.values() for k in g}
    out = []
    for n, (doc_id, text, *_) in enumerate(rows):
        own = [units[n, p] for p in range(len(cut(text)))] if doc_id is not None and text else []
        size = np.array([u[0] for u in own])
        hit = np.array([(n, p) in repeated for p in range(len(own))], bool)
        inside = paragraph_dedup.runs(hit, size, S) if len(own) else hit
        if inside.any():
            out.append((doc_id, len(own), int(inside.sum()), {p for p in np.flatnonzero(inside & hit).tolist() if first[n, p] != (n, p)}))
    return out


def test_paragraphs_divide_a_passage_alike_wherever_it_stands():
    rng = random.Random(5)
    prose = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    whole = 0
    for _ in range(60):
        passage = prose(60)
        one, two = (cut(" ".join([*prose(rng.randrange(30)), *passage, *prose(rng.randrange(30))])) for _ in range(2))
        inside = {tuple(p) for p in one if len(p) >= S.min_words} & {tuple(p) for p in two}
        whole += sum(map(len, inside)) >= S.min_run
    assert whole >= 55


def test_division_of_a_text_does_not_depend_on_its_neighbours():
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(40))) for _ in range(30)]
    raw, off = text_bytes(pa.array(texts))
    _, first, before = paragraph_dedup.paragraphs(raw, off, S.reach)
    assert np.diff(before).tolist() == [len(cut(t)) for t in texts]


def test_whole_table_against_brute_force(table):
    docs = table("documents")
    rows = sorted(tuple(r) for r in docs.collect())
    expected = {d: (n, inside, removed) for d, n, inside, removed in brute(rows)}
    got = {r.doc_id: r for r in paragraph_dedup.dedup(docs).collect()}
    assert set(got) == set(expected) and expected
    for d, r in got.items():
        n, inside, removed = expected[d]
        assert (r.n_paragraphs, r.n_repeated) == (n, inside) and r.n_removed >= len(removed)
        text = dict((x[0], x[1]) for x in rows)[d]
        assert len(WORD.findall(r.kept_text)) == len(WORD.findall(text)) - r.removed_words
        assert r.removed_words >= sum(len(cut(text)[p]) for p in removed)
        if d == min(expected):
            assert r.n_removed == 0 and r.kept_text == text


def test_edges(edge_docs, edge_rows, no_docs):
    got = paragraph_dedup.dedup(edge_docs).collect()
    assert {r.doc_id for r in got} == {d for d, *_ in brute(edge_rows)} >= {5, 6, 19}
    assert paragraph_dedup.dedup(no_docs).count() == 0


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.75**S.rows) ** S.bands >= S.recall > 1 - (1 - 0.75**S.rows) ** (S.bands - 1)


def test_passages_in_short_lines_are_found(spark):
    """60 words in lines of 5, and of 5 and 7 in turn, amid other short lines and inside prose."""
    rng = random.Random(8)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(60):
        passage = "\n".join(" ".join(prose(n)) for n in ([5] * 12, [5, 7] * 5)[k % 2])
        verse = "\n".join(" ".join(prose(4)) for _ in range(rng.randrange(1, 9)))
        rows += [(2 * k, f"{verse}\n{passage}\n{' '.join(prose(50))}"), (2 * k + 1, f"{' '.join(prose(30))}\n{passage}\n{verse[::-1]}")]
    got = {r.doc_id: r for r in paragraph_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(2 * k in got and 2 * k + 1 in got for k in range(60)) >= 57
    assert all(r.n_removed == 0 for d, r in got.items() if d % 2 == 0) and all(r.removed_words >= S.min_run for d, r in got.items() if d % 2)


def test_whole_lines_that_differ_in_a_few_words(spark):
    """Pairs of lines one or two words apart, against all pairs by exact Jaccard; the division into paragraphs is not used."""
    rng = random.Random(9)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(60):
        line = prose(40 if k % 2 else 80)
        other = list(line)
        for i in rng.sample(range(len(line)), 2 - k % 2):
            other[i] = "changed"
        rows += [(2 * k, "\n".join(" ".join(x) for x in (prose(15), line, prose(3)))), (2 * k + 1, "\n".join(" ".join(x) for x in (prose(9), other)))]
    rows += [(1000, " ".join(prose(60))), (1001, " ".join(prose(20)))]
    sets = [(d, len(x.split()), {tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)}) for d, text in rows for x in text.split("\n") if len(x.split()) >= S.min_run]
    pairs = {(d, e, n) for d, _, a in sets for e, n, b in sets if d < e and 4 * len(a & b) >= 3 * len(a | b)}
    assert len(pairs) >= 55
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # With so many bands that none of these pairs is left to chance.
    got = {r.doc_id: r for r in paragraph_dedup.dedup(docs, Settings(whole_lines=True, recall=0.999999)).collect()}
    for d, e, n in pairs:
        assert got[d].removed_words == 0 and got[d].kept_text == dict(rows)[d]
        assert got[e].removed_words >= n and got[e].kept_text.split() == dict(rows)[e].split("\n")[0].split()
    assert not {1000, 1001} & set(got)


def test_whole_lines_take_nothing_back(table, edge_docs):
    """Whole lines only add to what paragraphs find, and the first document of the table keeps its text."""
    for docs in (table("documents"), edge_docs):
        less = {r.doc_id: r for r in paragraph_dedup.dedup(docs).collect()}
        more = {r.doc_id: r for r in paragraph_dedup.dedup(docs, Settings(whole_lines=True)).collect()}
        assert set(less) <= set(more)
        assert all(more[d].removed_words >= r.removed_words and more[d].n_repeated >= r.n_repeated for d, r in less.items())


def test_release_takes_the_last_query_with_it(spark):
    """Shuffle files of the query that has just ended go, not only those of the one before."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    shuffled = lambda: {f.getName() for f in shared_list(env.blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    shared_list = lambda seq: [seq.apply(i) for i in range(seq.length())]
    old = shuffled()
    _, path = kept(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counts")
    made = shuffled() - old
    assert made
    release(spark)
    until = time.monotonic() + 10
    while made & shuffled() and time.monotonic() < until:
        time.sleep(0.2)
    assert not made & shuffled()
    drop(spark, path)


def test_sets_have_each_shingle_once():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab" if k % 2 else "abcdefghij") for _ in range(rng.randrange(6, 60))) for k in range(40)]
    raw, off = text_bytes(pa.array(texts))
    w = paragraph_dedup.words(raw, off, lower=True)
    sh, at = paragraph_dedup.sets_of(w, w.offsets[:-1], w.offsets[1:])
    for k, text in enumerate(texts):
        own = text.split()
        got = sh[at[k] : at[k + 1]].tolist()
        assert len(got) == len(set(got)) == len({tuple(own[i : i + 5]) for i in range(len(own) - 4)})


def test_bands_where_sets_meet():
    rng = np.random.default_rng(3)
    key, d1, n = rng.integers(0, 60, 150), rng.integers(0, 50, 150), rng.integers(1, 3, 150).astype(np.int32)
    got = set(zip(*[x.tolist() for x in paragraph_dedup.meetings(key, d1, n)], strict=True))
    bands, copies = defaultdict(lambda: defaultdict(int)), set()
    for k, d, c in zip(key.tolist(), d1.tolist(), n.tolist(), strict=True):
        bands[k][d] += c
    want = {(k, d, c) for k, b in bands.items() if len(b) > 1 for d, c in b.items()}
    copies = {(None, d, 0) for b in bands.values() if len(b) == 1 for d, c in b.items() if c > 1}
    assert got == want | copies and want and copies


def test_loose_copies_are_no_pairs(spark, monkeypatch):
    # Variants of one line that share each shingle with many others, and are alike by less than the wanted similarity.
    base = [f"w{i}" for i in range(30)]
    lines = set()
    rng = random.Random(6)
    while len(lines) < 60:
        lines.add(" ".join([f"{w}x{rng.randrange(3)}" if i in (4, 11, 18, 25) else w for i, w in enumerate(base)]))
    made = []
    confirm_with = paragraph_dedup.confirm_with

    def counted(sets, percent):
        confirm = confirm_with(sets, percent)

        def count(pairs):
            made.append(pairs.count())
            return confirm(pairs)

        return count

    monkeypatch.setattr(paragraph_dedup, "confirm_with", counted)
    docs = spark.createDataFrame(list(enumerate(sorted(lines))), "doc_id long, text string")
    paragraph_dedup.dedup(docs, Settings(whole_lines=True)).count()
    assert made[0] > 0 and made[-1] < 20


def test_runs_of_many_documents_at_once_are_those_of_each():
    # One pass over all documents of a slice: a run ends with its document, also if the next one begins with repeated paragraphs.
    rng, size, hit, home, doc = random.Random(9), [], [], [], []
    for d in range(300):
        for _ in range(rng.randrange(1, 12)):
            size.append(rng.randrange(1, 20))
            hit.append(size[-1] >= S.min_words and rng.random() < 0.7)
            home.append(rng.random() < 0.4)
            doc.append(d)
    size, hit, home, doc = np.array(size), np.array(hit), np.array(home), np.array(doc)
    which = np.flatnonzero(hit)
    inside, gone = paragraph_dedup.removable(which, home[which], size, S, doc)
    for d in range(300):
        own = doc == d
        units, within, goes = list(zip(size[own].tolist(), hit[own].tolist(), home[own].tolist(), strict=True)), [], []
        run = []
        for k, (n, is_hit, _) in enumerate([*units, (S.min_words, False, False)]):
            if is_hit or n < S.min_words:
                run.append(k)
                continue
            hits = [x for x in run if units[x][1]]
            span = range(hits[0], hits[-1] + 1) if hits else range(0)
            if sum(units[x][0] for x in span) >= S.min_run:
                within += span
                left = {x for x in hits if not units[x][2]}
                near = lambda x: (max(h for h in hits if h < x), min(h for h in hits if h > x))
                goes += [x for x in span if (x in left if units[x][1] else set(near(x)) <= left)]
            run = []
        assert np.flatnonzero(inside[own]).tolist() == within and np.flatnonzero(gone[own]).tolist() == goes
    assert inside.any() and gone.any() and (inside & ~hit).any() and not inside.all()
