"""Merge-dropout against a merger that looks through all pairs again for every merge."""

import random

import numpy as np
from pyspark.sql import functions as F

from supplyloom.llm import queries
from supplyloom.llm import sentencepiece_dropout as dropout

FULL = 2**64


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB % FULL
    return x ^ x >> 31


def naive(chunk, vocabulary, document, seed, place, share):
    """Merge the pair of lowest rank, then the leftmost, that the hash does not skip, until none is left."""
    own = mix((document + seed * 0xBF58476D1CE4E5B9 + place * 0x9E3779B97F4A7C15) % FULL)
    parts = [(at, c) for at, c in enumerate(chunk)]
    while True:
        best = None
        for i, ((at, a), (_, b)) in enumerate(zip(parts, parts[1:])):
            rank = vocabulary.ranks.get(a + b)
            if rank is None or mix(own ^ (rank * 2**32 + at) * 0x9E3779B97F4A7C15 % FULL) < int(share * FULL):
                continue
            if best is None or rank < best[0]:
                best = rank, i
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [(parts[i][0], parts[i][1] + parts[i + 1][1])]
    out = []
    for _, piece in parts:
        out += [vocabulary.ids[piece]] if piece in vocabulary.ids else [vocabulary.bytes[b] for b in piece.encode()]
    return out


def test_equals_the_naive_merger():
    rng = random.Random(11)
    letters = "etaoinshrdlucmfgyp ÄÖéñ日本語🎉́ \t\n.,;-0123456789²"
    words = ["internationalization", "the", "encyclopaedia", "straßenbahn", "🎉x", "a" * 40, "日本語", "<0x41>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(20))) for _ in range(60)]
    for share, seed in ((0.0, 0), (0.1, 3), (0.5, 0), (1.0, 9)):
        for together in (1, 1 << 17):
            mine = dropout.Encoder(dropout.MODEL, seed, share, together)
            packed = mine.encode_all(texts, list(range(len(texts))))
            for key, (text, got) in enumerate(zip(texts, packed, strict=True)):
                expected = []
                if text:
                    for place, chunk in enumerate(dropout.CHUNK.findall("▁" + text.replace(" ", "▁"))):
                        expected += naive(chunk, mine.vocabulary, dropout.document_key(key), seed, place, share)
                ids = np.frombuffer(got, dtype=np.int32)
                assert ids.tolist() == expected, (text, share)
                assert mine.decode(ids) == text


def test_checked_encoding_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (None, "no id"), (3, "▁"), (4, "x" * 100_000), (5, "word " * 50_000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, coded int")
    got = df.select("doc_id", F.length("text").alias("n"), dropout.encode_checked(F.col("text"), F.col("doc_id")).alias("c")).collect()
    assert all(r.c.lossless for r in got) and [r.c.pieces for r in got if not r.n] == [[], []]
    assert len({tuple(r.c.pieces) for r in got if r.doc_id is None}) == 1
    assert df.filter("false").select(dropout.encode_checked(F.col("text"), F.col("doc_id"))).count() == 0


def test_registered_query_encodes_once(spark, tmp_path):
    spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["op4_sentencepiece_dropout"](spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("coded(") == 1
    assert sorted((r.doc_id, r.n_pieces > 0, r.lossless) for r in df.collect()) == [(1, True, True), (2, False, True)]
