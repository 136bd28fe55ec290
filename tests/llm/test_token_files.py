import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def expected(tok, texts):
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_pieces_give_the_ids_of_the_whole_text(tok):
    encode, _ = token_files.encoder(FILE)
    texts = ["", " ", "a  b", "a   b\n\n c", "x  y 　z", "it's, we'll. 'tis \x1c\x1d q", "<|endoftext|>a <|endoftext|>", "a\x85b é,è; Ⅷ²,3", "tab\t\tend\t ", "汉字, kana かな!!", "word,word.word", "A|<|endoftext|>|", "é, ñ."]
    for t in texts:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("length, rows", [(16, 2), (2048, 64)])
def test_round_trip_of_a_whole_table(table, tok, length, rows):
    docs = table("documents")
    got = sorted(token_files.encode_table(docs, FILE, 2, length, rows).collect())
    start = 0
    for r, d, ids in zip(got, sorted(docs.collect()), expected(tok, [d.text for d in sorted(docs.collect())]), strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.masked
        start += len(ids)


def test_edges_and_the_files_themselves(edge_docs, edge_rows, tok):
    shards, root = token_files.write(edge_docs, FILE, 2, length=64, rows=3)
    got = token_files.read(shards, root, rows=3).collect()
    name = lambda d, ids: (d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    ids = expected(tok, [r[1] for r in edge_rows])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted((name(r[0], i) for r, i in zip(edge_rows, ids, strict=True)), key=str)
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is None for r in order] == sorted((r.doc_id is None for r in order), reverse=True)
    assert [r.doc_id for r in order if r.doc_id is not None] == sorted(r.doc_id for r in order if r.doc_id is not None)
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order)])[:-1].tolist()
    for s in shards.collect():
        ids_file, mask_file = (token_files.read_sequences(root, s.shard, k) for k in ("ids", "mask"))
        flat, mask = (np.concatenate([token_files.sequence(f, i, 3) for i in range(s.n_rows)]) for f in (ids_file, mask_file))
        assert len(flat) == 64 * s.n_rows and mask.sum() == s.n_tokens and mask[: s.n_tokens].all() and not flat[s.n_tokens :].any()


def test_empty(no_docs):
    assert token_files.encode_table(no_docs, FILE, 2).count() == 0


def test_sequences_are_views(table):
    shards, root = token_files.write(table("documents").filter(F.col("doc_id") < 20).coalesce(1), FILE, 2, length=128, rows=8)
    file = token_files.read_sequences(root, shards.first().shard)
    one = token_files.sequence(file, 0, 8)
    assert one.dtype == np.uint16 and not one.flags.owndata and not one.flags.writeable


def test_words_are_encoded_by_the_model_alone(table, tok):
    """A distinct word costs no pass over the whole tokenizer, and has the ids that pass would give."""
    encode_word = token_files.word_encoder(tok)
    found = {w for r in table("documents").collect() for w in token_files._WORD.findall(r.text or "")}
    assert len(found) > 1000
    for w in [*found, "a", " a", "É", " ÿþ", "Größe", " ñandúÀ", "xÖØöøÿ"]:
        assert encode_word(w) == tok.encode(w, add_special_tokens=False).ids, w


def test_added_tokens_inside_words_are_looked_for(tmp_path):
    from tokenizers import Tokenizer

    changed = Tokenizer.from_file(FILE)
    changed.add_tokens(["zq", " the"])
    assert token_files.word_encoder(changed) is None
    changed.save(str(tmp_path / "t.json"))
    encode, _ = token_files.encoder(str(tmp_path / "t.json"))
    assert encode("azqb the then").tolist() == changed.encode("azqb the then", add_special_tokens=False).ids
