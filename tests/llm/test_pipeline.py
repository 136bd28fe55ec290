import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerloom.llm import toxicity
from tests.llm import test_decontaminate, test_mixture, test_near_dedup

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, table):
    """Each stage on what its predecessor kept."""
    docs = table("documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert names == ["toxicity", "near_duplicates", "decontamination", "source_weights", "token_files"]
    rows = sorted(tuple(r) for r in docs.collect())

    model = toxicity.train(docs, table("labels"))
    safe = toxicity.probabilities(model, pa.array([r[1] for r in rows])) < 0.5
    out = stages["toxicity"](spark, docs, SF)
    assert out.columns == docs.columns
    rows = [r for r, s in zip(rows, safe, strict=True) if s]
    assert sorted(map(tuple, out.collect())) == rows and len(rows) < docs.count()

    out = stages["near_duplicates"](spark, out, SF)
    kept = {r[0] for r in test_near_dedup.brute(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == rows

    out = stages["decontamination"](spark, out, SF)
    leaks = {d for d, _ in test_decontaminate.brute(rows, [tuple(r) for r in table("benchmark").collect()])}
    rows = [r for r in rows if r[0] not in leaks]
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == rows

    out = stages["source_weights"](spark, out, SF)
    mixed = out.collect()
    size = lambda t: len(test_mixture.WORD.findall(t or ""))
    sizes, taken, texts = Counter(), Counter(), {r[0]: r[1] for r in rows}
    for r in rows:
        sizes[r[3]] += size(r[1])
    for r in mixed:
        taken[r.source] += size(r.text)
        assert texts[r.doc_id].startswith(r.text)
    assert out.columns == docs.columns
    for source, goal in test_mixture.water_fill(dict(sizes)).items():
        assert goal - 1 - 1e-6 <= taken[source] <= goal + 1e-6

    files = sorted(stages["token_files"](spark, out, SF).collect(), key=lambda r: r.start)
    ids = encoded([r.text for r in mixed])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in files) == Counter((r.doc_id, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(mixed, ids, strict=True))
    assert [r.start for r in files] == np.cumsum([0, *(r.n_tokens for r in files)])[:-1].tolist()
    assert [r.doc_id for r in files] == sorted(r.doc_id for r in files)


def encoded(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(corpus_pipeline.tokenizer_file())
    return [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "masked"] and got.count() > 100


def test_stages_on_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "token_files" or out.columns == docs.columns
            out.count()
