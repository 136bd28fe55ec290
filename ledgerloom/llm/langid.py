"""Language identification by compression.

For every language a raw-content zstandard dictionary is made of sampled pieces of text. A
text is cut into pieces of ``piece`` bytes (all of them are used), each piece is
compressed with every dictionary, and the language with the smallest total wins. A
text is accepted only if the runner-up needs clearly more bytes, else it is
rejected: the winner stays in ``lang_pred`` and ``accepted`` is false.

The dictionaries come from a bounded sample (see :func:`learn`): for each language
pieces of ``line_chars`` characters of documents chosen by hash, however long their
lines. Of what they hold the first ``dict_bytes`` are used. Every language is learned.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and
not accepted; ties go to the first language by name; if nothing can be learned
every text is ``und``; rows without doc_id are predicted and count as held out;
repeated rows are predicted one by one. Columns other than doc_id, text (and, to
learn from, lang) are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import mapped

UND = "und"


def held_out(doc_id: Column) -> Column:
    """True for rows that must not teach: crc32 of the id as text divisible by 5, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, sample_docs: int = 2000, dict_lines: int = 1000, line_chars: int = 200, all_lines: int = 200_000) -> dict[str, bytes]:
    """Dictionary content of each language; at most all_lines pieces, or one of each language, reach the driver.

    Of each language about ``sample_docs`` documents are read, chosen by hash of the
    id, and of the distinct pieces of ``line_chars`` characters that hold a letter the
    ``dict_lines`` of smallest hash; fewer if all languages would have more than
    ``all_lines``, which they share alike.
    """
    rows = docs.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    langs = rows.groupBy("lang").count().withColumn("most", F.greatest(F.lit(1), F.least(F.lit(dict_lines), F.floor(F.lit(all_lines) / F.count("*").over(Window.partitionBy())))))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    some = rows.join(F.broadcast(langs), "lang").filter(share < F.lit(sample_docs) / F.col("count"))
    lines = some.select("lang", "most", F.explode(F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % line_chars), F.lit(0))).alias("line")).filter(F.col("line").rlike(r"\p{L}"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("line"), "line")
    chosen = lines.distinct().withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= F.col("most")).orderBy("lang", "n")
    out: dict[str, list[str]] = {}
    for r in chosen.select("lang", "line").collect():
        out.setdefault(r.lang, []).append(r.line)
    return {k: "\n".join(v).encode() for k, v in sorted(out.items())}


def _letters_table() -> bytes:
    """Lower-cases A-Z and blanks all other ASCII that is no letter."""
    return bytes(b if b >= 128 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def plain(text: str, table: bytes) -> bytes:
    """Words of letters with one blank before each: case and marks say nothing about the language."""
    return b" " + b" ".join(text.encode().translate(table).split())


def classifier(dictionaries: dict[str, bytes], piece: int, dict_bytes: int):
    """A function from texts to the compressed bytes by language (texts x languages); -1 for texts without a letter."""
    import regex
    import zstandard

    table = _letters_table()
    # A binary-tree match finder: the faster ones index a dictionary too sparsely to judge short texts.
    how = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=17, search_log=4, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    tools = []
    for content in dictionaries.values():
        d = zstandard.ZstdCompressionDict(plain(content.decode(), table)[:dict_bytes], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=how)
        tools.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress)
    letter = regex.compile(r"\p{L}").search

    def sizes(texts: list[str | None]) -> np.ndarray:
        out = np.full((len(texts), len(tools)), -1, np.int64)
        for i, t in enumerate(texts):
            if t and letter(t):
                raw = plain(t, table)
                pieces = [raw[a : a + piece] for a in range(0, len(raw), piece)]
                out[i] = [sum(len(c(p)) for p in pieces) for c in tools]
        return out

    return sizes


def decide(names: list[str], sizes: np.ndarray, nats_per_byte: float = 0.5, margin: float = 0.02) -> dict:
    """Winner, score and acceptance for rows of compressed sizes.

    The score is the winner's weight among all languages, each weighing
    exp(-nats_per_byte x bytes); ``margin`` is the share of the winner's bytes by
    which the runner-up must be larger.
    """
    if not names:
        n = len(sizes)
        return {"lang_pred": np.full(n, UND, object), "score": np.zeros(n), "accepted": np.zeros(n, bool)}
    known = sizes[:, 0] >= 0
    first = sizes.argmin(1)
    least = sizes.min(1)
    over = sizes - least[:, None]
    score = 1 / np.exp(-nats_per_byte * over).sum(1)
    second = np.sort(over, 1)[:, 1] if len(names) > 1 else np.full(len(sizes), np.iinfo(np.int64).max)
    return {
        "lang_pred": np.where(known, np.array(names, object)[first], UND),
        "score": np.where(known, score, 0.0),
        "accepted": known & (second > margin * least),
    }


def identify(docs: DataFrame, dictionaries: dict[str, bytes], piece: int = 4096, dict_bytes: int = 48 << 10, margin: float = 0.02) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted for every row."""
    names = list(dictionaries)
    state: dict = {}

    def work(part: pa.RecordBatch) -> dict:
        if "sizes" not in state:  # made once in each task
            state["sizes"] = classifier(dictionaries, piece, dict_bytes)
        return {"doc_id": part.column(0), "held_out": part.column(2)} | decide(names, state["sizes"](part.column(1).to_pylist()), margin=margin)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return mapped(rows, work, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
