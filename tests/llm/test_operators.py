"""Every corpus operator against brute force or a stated result, with NULL, empty, long, tied and repeated rows."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from supplyloom.llm import (
    cover_tree,
    decontaminate,
    language,
    line_dedup,
    personal_data,
    quality,
    sentencepiece_dropout,
    simhash,
    toxicity,
    url_rules,
)
from supplyloom.llm.common import lower_ascii
from supplyloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, line string, words string"
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None, langs=None):
    """Rows with extra columns whose names clash with those that operators use inside."""
    ids = ids or list(range(len(texts)))
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame(
        [(i, t, g, "s", len(t or ""), "x", "y", "z") for i, t, g in zip(ids, texts, langs, strict=True)], DOCS
    )


def variants(rng, n, words=30, pool=400):
    """Random texts, some of them edited copies of others."""
    vocabulary = [f"w{rng.randrange(10**6)}" for _ in range(pool)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            copy = rng.choice(out).split(" ")
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
        else:
            out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, words))))
    return out


def test_lower_ascii_leaves_other_letters(spark):
    df = spark.createDataFrame([("ÄBc",), ("ABC",), (None,)], "t string").select(lower_ascii(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["Äbc", "abc", None]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 ---------------------------------------------------------------------------------------------------


def test_top_k_equals_brute_force_with_ties(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 40)
    monkeypatch.setattr(cover_tree, "LEAF", 4)
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(20)]
    vectors = [(i, [x + rng.choice([0, 0, 0.01]) for x in rng.choice(base)]) for i in range(300)]
    rows = [(i, v, i) for i, v in vectors] + [(900, None, 0), (950, [1.0, None], 0), (1000, [float("nan")] * 6, 0), (1050, [float("inf")] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int")
    q = cover_tree.quantized(df)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in cover_tree.top_k(q, q.filter("vec_id % 50 = 0")).collect()}
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in vectors}
    expected = {}
    for i in range(0, 300, 50):
        scored = sorted((-sum(a * b for a, b in zip(ints[i], v, strict=True)), j) for j, v in ints.items() if j != i)[:5]
        expected |= {(i, k): (j, -s) for k, (s, j) in enumerate(scored, 1)}
    assert got == expected


@pytest.mark.parametrize("block", [16, 2048])
def test_top_k_counts_a_repeated_id_once(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "LEAF", 4)
    rng = random.Random(12)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    for i in rng.sample(range(120), 40):
        v = [4 * x for x in vectors[i][1]]
        vectors += [(i, v)] * 6 + [(i, [x + rng.choice([0, 0.02]) for x in v]) for _ in range(6)]
    df = cover_tree.quantized(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in cover_tree.top_k(df, df.filter("vec_id % 20 = 0")).collect()}
    ints = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in vectors]
    expected = {}
    for i in range(0, 120, 20):
        best = {}
        for _, q in (row for row in ints if row[0] == i):
            for j, v in ints:
                if j != i:
                    best[j] = max(best.get(j, -(10**18)), sum(a * b for a, b in zip(q, v, strict=True)))
        scored = sorted((-s, j) for j, s in best.items())[:5]
        expected |= {(i, k): (j, -s) for k, (s, j) in enumerate(scored, 1)}
    assert got == expected


def test_top_k_with_few_or_no_vectors(spark):
    df = cover_tree.quantized(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "vec_id long, embedding array<float>"))
    got = cover_tree.top_k(df, df.filter("vec_id = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 256 * 256)]
    assert cover_tree.top_k(df.filter("false"), df.filter("false")).count() == 0


# --- 2 ---------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 13 <= len(digits) <= 19 and personal_data.luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            )
            if fine:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["a.b@c.de", "@", "x@y", "a@b@c.d.e", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4539 1488 0343 6467", "4539148803436467", "+49 (30) 123-4567", "+1", " ", ".", "-", "ä", "12", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_personal_data_report(spark):
    long = "a" * 300_000 + " 1" * 50_000 + " me@example.com " + "9" * 100_000
    texts = ["ä me@example.com, call +49 30 1234567", None, "", "no data", long, "from 10.0.0.1 card 4539148803436467"]
    rows = {r.doc_id: r for r in personal_data.report(docs_of(spark, texts)).collect()}
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for _, r in sorted(rows.items())] == [(1, 0, 0, 1), (0,) * 4, (0,) * 4, (0,) * 4, (1, 0, 0, 0), (0, 1, 1, 0)]
    for i, t in enumerate(texts):
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t or "")) if i != 4 else None
        if base is not None:
            assert rows[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert set(base.split(",")) <= set(rows[i].spans.split(","))
    assert personal_data.report(spark.createDataFrame([], EMPTY)).count() == 0


def test_em_trusts_the_labelers_that_agree():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    def voter(right):
        return np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    votes = np.stack([voter(0.95), voter(0.9), voter(0.9), voter(0.5), voter(0.8)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = personal_data.estimate(patterns, counts.astype(float))
    guess = model.posterior(votes) > 0.5
    assert (guess == truth).mean() > 0.95
    assert model.tables[0, 1, 2] > model.tables[3, 1, 2]


# --- 3 ---------------------------------------------------------------------------------------------------


def test_urls_host_path_and_given_rules(spark):
    cases = [
        ("https://A.Example.NET/en/1?x=1#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://x.net", "x.net", "", None, "allow"),
        ("http://x.net/", "x.net", "/", "net/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://a.org/fr/?q", "a.org", "/fr/", "org/fr/", "allow"),
        ("http://h?a/b", "h", "", None, "allow"),
        ("no scheme/net/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "t") for i, c in enumerate(cases)] + [(None, cases[0][0], "t")], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge(pages, labels).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(cases))] == [c[1:] for c in cases]
    assert got[None].rule == "example.net/en/"


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(5)
    tokens = list("abcdef")
    rows = []
    for _ in range(400):
        have = [t for t in tokens if rng.random() < 0.4]
        bad = {"a", "b"} <= set(have) or rng.random() < 0.1
        rows.append((have, url_rules.BLOCK if bad else url_rules.ALLOW))
    kept = {tuple(r.tokens): r.confidence for r in url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.8).collect()}
    every = {}
    for size in range(1, 7):
        for some in combinations(tokens, size):
            has = [label for have, label in rows if set(some) <= set(have)]
            hits = has.count(url_rules.BLOCK)
            if hits >= 0.05 * len(rows) and hits / len(has) >= 0.8:
                every[some] = hits / len(has)
    expected = {s: c for s, c in every.items() if not any(set(t) < set(s) and d >= c for t, d in every.items())}
    assert kept.keys() == expected.keys() and ("a", "b") in kept
    urls = spark.createDataFrame([("u1", ["a", "b", "z"]), ("u2", ["a"]), ("u3", []), ("u4", ["b", "a"])], "url string, tokens array<string>")
    rules = spark.createDataFrame([(["a", "b"], 0.9)], "tokens array<string>, confidence double")
    assert sorted(r.url for r in url_rules.matching(urls, rules).collect()) == ["u1", "u4"]


# --- 4 ---------------------------------------------------------------------------------------------------


def test_without_dropout_pieces_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_dropout.MODEL)
    mine = sentencepiece_dropout.Encoder(sentencepiece_dropout.MODEL, 0, 0.0, 1)
    for text in ["Hello world", " two  spaces ", "Ärger über Öl\nund\n\nmehr", "日本語 text 🎉", "a" * 300, "x", "tab\there", "The quick, brown fox."]:
        ids = np.frombuffer(mine.encode(text, 1), dtype=np.int32).tolist()
        assert ids == sp.encode(text), text
        assert mine.decode(ids) == text


def test_dropout_varies_and_is_lossless(spark):
    texts = ["the encyclopedia of internationalization " * 20, None, "", "▁ literal ▁▁ marks", "nul \x00 and   and 🎉", "é" * 5000, "the encyclopedia of internationalization " * 20]
    df = docs_of(spark, texts)
    text = F.coalesce("text", F.lit(""))
    coded = df.select("doc_id", text.alias("text"), sentencepiece_dropout.encode(text, F.col("doc_id"), dropout=0.3).alias("p"))
    rows = {r.doc_id: r for r in coded.withColumn("back", sentencepiece_dropout.decode(F.col("p"))).collect()}
    assert all(r.back == r.text for r in rows.values())
    assert rows[1].p == rows[2].p == []
    plain = np.frombuffer(sentencepiece_dropout.Encoder(sentencepiece_dropout.MODEL, 0, 0.0, 1).encode(texts[0], 0), dtype=np.int32)
    assert len(rows[0].p) > len(plain)
    again = {r.doc_id: r.p for r in coded.repartition(3).collect()}
    assert again == {i: r.p for i, r in rows.items()}
    mine = sentencepiece_dropout.Encoder(sentencepiece_dropout.MODEL, 0, 0.3, 4)
    assert len({tuple(sentencepiece_dropout.cut("▁internationalization", mine.vocabulary, v, 0, 0.3)) for v in range(8)}) > 1


def test_every_occurrence_is_cut_on_its_own():
    text = "the encyclopedia of internationalization, " * 400 + "é" * 100 + " ▁ the end"
    mine = sentencepiece_dropout.Encoder(sentencepiece_dropout.MODEL, 7, 0.1)
    chunks = sentencepiece_dropout.CHUNK.findall("▁" + text[: text.index(" ▁")].replace(" ", "▁"))
    cuts = {}
    expected = []
    for place, chunk in enumerate(chunks):
        ids = sentencepiece_dropout.cut(chunk, mine.vocabulary, sentencepiece_dropout.document_key(5), 7, 0.1, place)
        cuts.setdefault(chunk, set()).add(tuple(ids))
        expected += ids
    got = np.frombuffer(mine.encode(text, 5), dtype=np.int32).tolist()
    assert got[: len(expected)] == expected and mine.decode(got) == text
    assert len(cuts["▁internationalization"]) > 4 and len(cuts["▁encyclopedia"]) > 4
    small = sentencepiece_dropout.Encoder(sentencepiece_dropout.MODEL, 7, 0.1, 3)  # the cache changes nothing
    assert small.encode_all([text, None, text], [6, 1, 5]) == [mine.encode(text, 6), b"", mine.encode(text, 5)]
    assert mine.encode(text, 5) != mine.encode(text, 6)


# --- 5 ---------------------------------------------------------------------------------------------------


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(2)
    pool = ["the", "of", "Ä", "a", "to", "x9"] + [f"t{i}" for i in range(30)]
    items = [" ".join(rng.choice(pool) for _ in range(n)) for n in (3, 9, 10, 11, 25, 40)] + [None, "", "...", "zzz"]
    items.append(items[4])
    texts = [None, "", "!!"]
    for _ in range(60):
        words = [rng.choice(pool) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.7:
            w = (rng.choice(items) or "").split()
            a = rng.randrange(len(w) + 1)
            words[5:5] = w[a : a + rng.randrange(8, 30)]
        texts.append(rng.choice([" ", ", ", "-"]).join(words).title())
    ids = list(range(len(texts))) + [5, 6]
    texts += [texts[5], "the of a"]
    bench = spark.createDataFrame([(i, t, "q") for i, t in enumerate(items)], "item_id long, text string, phrase string")
    got = sorted(tuple(r) for r in decontaminate.contamination(docs_of(spark, texts, ids), bench).collect())
    phrases = {}
    for i, t in enumerate(items):
        w = plain_words(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            phrases.setdefault(tuple(w[a : a + 10]), set()).add(str(i))
    expected = []
    for i, t in zip(ids, texts, strict=True):
        w, hit, found = plain_words(t), set(), set()
        for p, names in phrases.items():
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a : a + len(p)]) == p:
                    hit |= set(range(a, a + len(p)))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    assert got == sorted(expected) and any(r[5] for r in got)
    kept = decontaminate.drop_contaminated(docs_of(spark, texts, ids), bench)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected if not r[5])
    assert kept.columns == docs_of(spark, texts, ids).columns
    none = bench.filter("false")
    assert decontaminate.contamination(docs_of(spark, texts, ids), none).filter("contaminated").count() == 0
    assert decontaminate.contamination(spark.createDataFrame([], EMPTY), bench).count() == 0


def test_proximity_matches(spark):
    docs = docs_of(spark, ["a x b", "b x x x a", "a a", None])
    terms = spark.createDataFrame([("a",), ("b",)], "term string")
    index = decontaminate.build_index(docs, terms)
    pairs = spark.createDataFrame([("a", "b"), ("a", "a")], "first string, second string")
    got = sorted((r.doc, r["first"], r.second, r.pos, r.other) for r in decontaminate.proximity_matches(index, pairs, 2).collect())
    assert got == [(0, "a", "b", 0, 2), (2, "a", "a", 0, 1), (2, "a", "a", 1, 0)]


# --- 6 ---------------------------------------------------------------------------------------------------


def test_simhash_equals_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "one", "One", "one two", "  one  two "] + variants(rng, 150, words=60)
    texts += [texts[20]] * 5
    df = docs_of(spark, texts)
    fps = []
    for t in texts:
        w = (t or "").encode().lower().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).collect())
    assert got == [(i, f"{fps[i]:016x}", group[i]) for i in range(len(texts))]
    kept = simhash.drop_near_duplicates(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group)) and kept.columns == df.columns
    assert simhash.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_simhash_links_all_flips_of_one_and_two_bits(spark):
    rng = random.Random(6)
    base = rng.getrandbits(63)
    flips = [base ^ (1 << a) ^ (1 << b) for a, b in combinations(range(0, 63, 7), 2)] + [base]
    far = [rng.getrandbits(63) for _ in range(50)]
    got = simhash.links(spark.createDataFrame([(f,) for f in {*flips, *far}], "fp long"))
    roots = {r.node: r.root for r in components(got).collect()}
    assert set(roots) == set(flips) and len(set(roots.values())) == 1


def test_simhash_of_repeated_ids(spark):
    df = docs_of(spark, ["a b c d", "a b c d", "x y z", None], ids=[1, 1, 1, None])
    assert simhash.near_duplicates(df).count() == 4
    # one row of each group stays, not one of each id
    assert sorted((str(r.doc_id), str(r.text)) for r in simhash.drop_near_duplicates(df).collect()) == [("1", "a b c d"), ("1", "x y z"), ("None", "None")]


# --- 7, 8 ------------------------------------------------------------------------------------------------


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_quality_learns_and_scores_everything(spark):
    rng = random.Random(7)
    pool = [f"{a}{b}" for a in ("ther", "ing", "ea", "on", "er") for b in ("and", "th", "st", "re", "en")]
    texts = [prose(rng, pool, 40) if i % 2 else " ".join(f"{w}%%%" for w in prose(rng, pool, 40).split()) for i in range(300)]
    texts += [None, "", "x" * 300_000]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge(docs_of(spark, texts), labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert len(rows) == 303 and len(held) > 30
    assert all(r.predicted == r.doc_id % 2 for r in held)
    assert all(0 <= r.score <= 1 for r in rows)
    none = quality.judge(docs_of(spark, texts[:3]), labels.filter("false")).collect()
    assert [r.predicted for r in none] == [0, 0, 0]


def test_language_with_und(spark):
    rng = random.Random(8)
    english, german = ["the", "and", "thing", "other", "with"], ["der", "und", "nicht", "schön", "über"]
    texts = [prose(rng, english if i % 2 else german, 12) for i in range(200)] + [None, "", "123 !?", "Ω", "und " * 50_000]
    langs = ["en" if i % 2 else "de" for i in range(200)] + [None] * 5
    rows = {r.doc_id: r for r in language.identify(docs_of(spark, texts, langs=langs)).collect()}
    assert all(rows[i].lang_pred == langs[i] for i in range(200) if rows[i].held_out)
    assert [rows[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and rows[200].score == 0
    assert rows[203].lang_pred in ("de", "en") and rows[204].lang_pred == "de"
    assert language.identify(spark.createDataFrame([], EMPTY)).count() == 0


def test_hashed_features_of_blocks_equal_those_of_the_whole(monkeypatch):
    from supplyloom.llm import subwords

    text = " ".join(f"Wörd{i % 7} again again" for i in range(300))
    whole = np.sort(np.concatenate(list(subwords.hashed(text, "raw"))))
    monkeypatch.setattr(subwords, "BLOCK", 64)
    assert (np.sort(np.concatenate(list(subwords.hashed(text, "raw")))) == whole).all()
    # "ab cd": 3-grams <ab ab> <cd cd>, 4-grams <ab> <cd>, two words
    assert sum(map(len, subwords.hashed("ab cd", "raw"))) == 4 + 2 + 0 + 2
    assert list(subwords.hashed(None, "raw")) == [] and list(subwords.hashed(" \n", "raw")) == []


# --- 9 ---------------------------------------------------------------------------------------------------


def plain_removed(texts):
    lines = [(i, k, frozenset(line.split())) for i, t in enumerate(texts) for k, line in enumerate((t or "").split("\n"))]
    out = {i: [] for i in range(len(texts))}
    for at, (i, k, s) in enumerate(lines):
        if s and any(o and 5 * len(s & o) >= 4 * len(s | o) for _, _, o in lines[:at]):
            out[i].append(k)
    return out


@pytest.mark.parametrize("long", [1, 128])
def test_line_dedup_equals_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(line_dedup, "LONG", long)
    rng = random.Random(9)
    lines = variants(rng, 260, words=14, pool=60)
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 6))) for _ in range(120)]
    texts += [None, "", "\n\n", "one line only\n \n\tone  line only"]
    df = docs_of(spark, texts)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    expected = plain_removed(texts)
    assert {i: list(r["__gone"]) for i, r in got.items()} == expected
    assert all(got[i]["__lines"] == len((t or "").split("\n")) for i, t in enumerate(texts))
    kept = line_dedup.drop_lines(df)
    assert kept.columns == df.columns
    for r in kept.collect():
        t = texts[r.doc_id]
        gone = set(expected[r.doc_id])
        assert r.text == (t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))


def test_line_dedup_of_repeated_rows_and_empty_tables(spark):
    df = docs_of(spark, ["a b c", "a b c", "a b c", "a b c"], ids=[1, 1, 2, None])
    got = sorted((str(r.doc_id), list(r["__gone"])) for r in line_dedup.dedup_lines(df).collect())
    assert got == [("1", [0]), ("1", [0]), ("2", [0]), ("None", [])]
    assert line_dedup.dedup_lines(spark.createDataFrame([], EMPTY)).count() == 0


def test_line_dedup_of_many_texts_under_one_id(spark):
    rng = random.Random(13)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(10)) for _ in range(700)]
    texts = [f"{base[i]}\n{base[i + 1]} own{i}" if i % 3 else f"{base[i // 2]}\nclean{i} line{i}" for i in range(699)]
    ids = [None if i % 2 else 7 for i in range(699)]
    df = docs_of(spark, texts, ids=ids)
    gone = {r.text: set(r["__gone"]) for r in line_dedup.dedup_lines(df).collect()}
    order = sorted(range(699), key=lambda i: (ids[i] is not None, xxhash_of(spark, df)[texts[i]]))
    removed = plain_removed([texts[i] for i in order])
    assert gone == {texts[i]: set(removed[k]) for k, i in enumerate(order)}
    assert any(gone.values()) and not all(gone.values())


def test_line_dedup_holds_the_common_tokens_in_a_table_of_fixed_size(spark):
    """The plan holds one byte for a bucket, not the numbers of all common ones; rare tokens stay at 0."""
    df = docs_of(spark, [" ".join(["the"] * 300 + ["of"] * 1_000 + [f"w{i}"]) for i in range(3)])
    table = line_dedup._levels(df, "text")
    at = {r.token: r.at for r in df.select(F.explode(F.split("text", " ")).alias("token")).distinct().select("token", line_dedup._bucket(F.xxhash64("token")).alias("at")).collect()}
    assert len(table) == line_dedup.BUCKETS and sum(map(bool, table)) == 2
    assert (table[at["the"]], table[at["of"]], table[at["w1"]]) == (2, 2, 0)


def test_line_dedup_keeps_the_table_of_levels_out_of_its_joins(spark, monkeypatch):
    plans, store = [], line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df: plans.append(len(df._jdf.queryExecution().toString())) or store(df))
    df = docs_of(spark, ["a b c d e f\ng h i", "a b c d e f k\ng h i"])
    plans.append(len(line_dedup.dedup_lines(df)._jdf.queryExecution().toString()))
    assert sum(plans) < 16 * line_dedup.BUCKETS


def test_line_dedup_cuts_only_pairs_that_share_enough_of_their_prefixes(spark, monkeypatch):
    rng = random.Random(17)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.sample(words, 100) + [f"own{k}x{i}" for i in range(100)]) for k in range(6)]
    texts += [" ".join([*words[:95], *(f"new{k}x{i}" for i in range(5))]) for k in range(3)]
    cut, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda docs, pairs, *c: cut.extend(pairs.collect()) or verified(docs, pairs, *c))
    gone = {r.doc_id: list(r["__gone"]) for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert gone == {i: [0] if i in (7, 8) else [] for i in range(9)} == plain_removed(texts)
    assert {(r.other_doc, r.doc) for r in cut} <= {(6, 7), (6, 8), (7, 8)}


def test_line_dedup_takes_each_open_pair_of_a_long_list_once(spark, monkeypatch):
    """Variants that share most of their words, but too few: pairs leave the join of the open lines once, not per shared token."""
    monkeypatch.setattr(line_dedup, "LONG", 2)
    rng = random.Random(19)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:48] + rng.sample(words[48:], 6) + [f"own{k}x{i}" for i in range(3)]) for k in range(40)]
    taken, plausible = [], line_dedup._plausible
    monkeypatch.setattr(line_dedup, "_plausible", lambda pairs, classes: taken.append((pairs.count(), pairs.distinct().count())) or plausible(pairs, classes))
    gone = {r.doc_id: list(r["__gone"]) for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert gone == plain_removed(texts) and any(gone.values())
    assert taken[-1][0] == taken[-1][1] > 0


def test_line_dedup_keeps_one_stored_table(spark):
    """What is stored on the way goes; the numbers of the removed lines stay for the caller."""
    from supplyloom.session import shared_folder

    place = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    stored = lambda: {f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)}
    before = stored()
    gone = line_dedup.dedup_lines(docs_of(spark, ["a b c\nd e f", "a b c", "d e f g h"]))
    assert [list(r["__gone"]) for r in gone.orderBy("doc_id").collect()] == [[], [0], []]
    assert len(stored() - before) == 1


def xxhash_of(spark, df, known={}):
    """The order of texts under one id: by the upper bits of the version, unsigned."""
    if not known:
        version = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").isNull(), F.col("text")), 33)
        known |= {r.text: r.v for r in df.select("text", version.alias("v")).collect()}
    return known


# --- 10 --------------------------------------------------------------------------------------------------


def test_grammar_scores_clauses_not_words():
    symbols = toxicity._Symbols({"idiot": 4.0, "blar*": 3.0})

    def read(text):
        return toxicity.read_clauses(toxicity.WORD_OR_STOP.findall(text.lower()), symbols)

    assert read("an idiot")[toxicity.PLAIN] == 4.0
    assert read("you idiot")[toxicity.AIMED] > 4.0
    assert read("not an idiot")[toxicity.NEGATED] < 2.0
    assert read("not here. idiot")[toxicity.PLAIN] == 4.0
    assert 0 < read("she said idiot")[toxicity.REPORTED] < 4.0
    assert read("i will kill you")[toxicity.THREAT] == 1.0
    assert read("i will kill time")[toxicity.THREAT] == 0.0
    assert read("never kill you")[toxicity.THREAT] == 0.0
    assert read("blarument")[toxicity.PLAIN] == 3.0
    assert read("").sum() == 0


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(10)
    pool = [f"{a}{b}" for a in ("ther", "ing", "ea", "on", "er") for b in ("and", "th", "st", "re", "en")]
    ends = ["a", "be", "co", "du", "en", "fi"]
    texts, toxic = [], []
    for i in range(400):
        words = prose(rng, pool, 30).split()
        if i % 4 == 0:
            words[3] = words[9] = words[15] = rng.choice(["scum", "zorg" + rng.choice(ends)])
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    texts += [None, "", "scum " * 60_000]
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.judge(docs_of(spark, texts), labels).collect()}
    assert all(rows[i].predicted == toxic[i] for i in range(400) if rows[i].held_out)
    assert rows[400].predicted == rows[401].predicted == 0 and rows[402].predicted == 1
    assert all(r.predicted == 0 for r in toxicity.judge(docs_of(spark, texts[:5]), labels.filter("false")).collect())
