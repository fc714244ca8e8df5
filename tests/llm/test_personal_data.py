"""Spans that the method adds: planted ones are found, look-alikes and clean texts stay alone, base spans never change."""

import random

import numpy as np

from supplyloom.llm import personal_data

WORDS = "the harbour was quiet and small boats lay along a wall while children ran past it looking for shells".split()


def planted(rng):
    """(text to plant, kind), written so that no base pattern finds it."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    host = rng.choice(["mail", "post", "acme"])
    return rng.choice(
        [
            (f"write mail to {rng.choice(WORDS)}{n(2)} (at) {host}{n(1)}.com", "email"),
            (f"server host {rng.randrange(256)}[.]{rng.randrange(256)}[.]{rng.randrange(256)}[.]{rng.randrange(256)}", "ip"),
            (f"please call 030 {n(4)} {n(4)}", "phone"),
            (f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"', "secret"),
            (f"api key: {''.join(rng.choice('0123456789abcdefXYZ') for _ in range(32))}", "secret"),
        ]
    )


def decoy(rng):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice(
        [f"from 19{n(2)}-19{n(2)} on", "we met at noon. Then home", f"order {n(3)}-{n(2)}", f"page {n(2)}.{n(1)}", f"commit {'ab1' * 13}x", f"in {n(4)}", f"version {n(1)}.{n(1)}"]
    )


def corpus(rng, n):
    docs = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(30)]
        kind = None
        if i % 3 == 0:
            text, kind = planted(rng)
            words[15:15] = [text]
        elif i % 3 == 1:
            words[15:15] = [decoy(rng)]
        if i % 9 == 4:
            words[5:5] = [rng.choice(["me@example.com", "+49 30 1234567", "10.0.0.1", "4539 1488 0343 6467"])]
        docs.append((i, " ".join(words), kind))
    return docs


def test_planted_spans_are_added_and_clean_texts_left_alone(spark):
    docs = corpus(random.Random(3), 1500)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in docs], "doc_id long, text string, spans string, votes int")
    rows = {r.doc_id: r for r in personal_data.report(df).collect()}
    want = [i for i, _, kind in docs if kind]
    found = [i for i in want if any(s.startswith(dict((d[0], d[2]) for d in docs)[i] + ":") for s in rows[i].spans.split(","))]
    assert len(found) >= 0.9 * len(want)
    assert not [docs[i][1] for i, _, kind in docs if not kind and rows[i].n_added]
    for i, text, _ in docs:
        base = personal_data.base_spans(text)
        assert rows[i].n_spans - rows[i].n_added == len(base) == rows[i].n_email + rows[i].n_ip + rows[i].n_card + rows[i].n_phone
        assert all(f"{k}:{a}:{b}" in rows[i].spans.split(",") for k, a, b in base)


def test_repeated_and_odd_rows(spark):
    rows = [(1, 'token = "0a1b2c3d4e5f6a7b8c9d0e1f"'), (1, 'token = "0a1b2c3d4e5f6a7b8c9d0e1f"'), (None, None), (2, ""), (3, "x" * 200_000 + " 1" * 20_000)]
    got = personal_data.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5 and [r.spans for r in got if r.doc_id == 1] == ["secret:9:33"] * 2
    assert [r.n_spans for r in got if r.doc_id in (2, None)] == [0, 0]


def test_candidates_touch_no_other_span():
    rng = random.Random(8)
    parts = ["a.b@c.de", "1.2.3.4", "4539148803436467", "+49 (30) 123-4567", " ", "030 123 45", "x at y.com", "ab12" * 6, "-", "10[.]1[.]1[.]1", "1234 5678 9012"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 8)))
        spans = personal_data.candidates(text)
        base, loose = [s[:3] for s in spans if s[3]], [s for s in spans if not s[3]]
        assert base == personal_data.base_spans(text)
        for n, (_, a, b, _) in enumerate(loose):
            assert not any(x < b and a < y for _, x, y in base)
            assert not any(x < b and a < y for _, x, y, _ in loose[:n])


def test_kinds_have_their_own_reliabilities(spark):
    docs = corpus(random.Random(4), 900)
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    from pyspark.sql import functions as F

    reliability, weights = personal_data.train(df.select(personal_data.candidate_spans(F.col("text")).alias("spans")))
    assert set(reliability) == set(weights) == set(personal_data.KINDS)
    assert not np.allclose(reliability["email"].tables, reliability["secret"].tables)
