"""Balanced mixing, filter audit and importance resampling against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from supplyloom.llm import balanced_mix, filter_audit, importance, queries
from supplyloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n int, size long, part string, base string, bucket int"


def docs_of(spark, rows):
    """Rows (id, text, lang, source) with extra columns named like those that the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, "p", "b", 3) for r in rows], DOCS)


def ascii_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


# --- mix ------------------------------------------------------------------------------------------------------


def plain_targets(sizes):
    """Deal out by weight, cap, and deal the excess out again until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while free and rest > 1e-9:
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        rest = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def mixed(spark, rows, monkeypatch=None, block=None):
    if block:
        monkeypatch.setattr(balanced_mix, "BLOCK", block)
    return balanced_mix.per_row(balanced_mix.mix_plan(docs_of(spark, rows))).collect()


@pytest.fixture(scope="module")
def mix_rows():
    rng = random.Random(5)
    sources = ["a"] * 12 + ["b"] * 4 + ["c", "", None, "é", "Z"]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, rng.randrange(400)])), "en", rng.choice(sources)) for i in range(1500)]


def test_mix_meets_targets_and_balances(spark, mix_rows, monkeypatch):
    got = mixed(spark, mix_rows, monkeypatch, block=100)
    assert sorted(r.doc_id for r in got) == list(range(1500))
    sizes = {i: len(ascii_words(t)) for i, t, _, _ in mix_rows}
    totals, taken, copies, rows = Counter(), Counter(), Counter(), Counter()
    for r in got:
        assert r["size"] == sizes[r.doc_id] and r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        totals[r.source] += r["size"]
        taken[r.source] += r.taken
        copies[r.source] += r.copies
        rows[r.source] += 1
    expected = plain_targets(totals)
    for r in got:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(expected[r.source])
    for s in totals:
        rate = expected[s] / totals[s]
        assert abs(taken[s] - expected[s]) <= 10  # words are balanced to the landing problem
        assert abs(copies[s] - rate * rows[s]) <= balanced_mix.LANDING


def test_mix_does_not_depend_on_partitions_or_reruns(spark, mix_rows, monkeypatch):
    monkeypatch.setattr(balanced_mix, "BLOCK", 100)
    frame = docs_of(spark, mix_rows)
    runs = [
        sorted((r.doc_id, r.taken) for r in balanced_mix.per_row(balanced_mix.mix_plan(df)).collect())
        for df in (frame.repartition(7), frame.orderBy(F.desc("text")), frame.coalesce(1))
    ]
    assert runs[0] == runs[1] == runs[2]
    other = sorted((r.doc_id, r.taken) for r in balanced_mix.per_row(balanced_mix.mix_plan(frame, seed="other")).collect())
    assert other != runs[0]


def test_flight_keeps_means_and_totals():
    rng = np.random.default_rng(1)
    p, size = rng.random(300), rng.integers(0, 50, 300)
    p[:7], size[40:60] = 0.0, 12
    out = balanced_mix.flight(p, size, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2 and (out[:7] == 0).all()
    assert out.sum() == pytest.approx(p.sum(), abs=1e-5) and out @ size == pytest.approx(p @ size, abs=1e-3)
    small, sizes = np.array([0.2, 0.5, 0.7, 0.4, 0.6, 0.3]), np.array([5, 1, 9, 2, 2, 7])
    draws = np.mean([balanced_mix.flight(small, sizes, np.random.default_rng(i)) for i in range(4000)], axis=0)
    assert np.abs(draws - small).max() < 0.03


def test_landing_takes_the_nearest_subset():
    p, size = np.array([1.0, 0.5, 0.5, 0.25, 0.0]), np.array([100, 10, 7, 4, 50])
    assert list(balanced_mix.landing(p, size)) == [1.0, 1.0, 0.0, 0.0, 0.0]  # 9.5 words wanted, 10 are nearest


def test_mix_of_odd_rows(spark):
    rows = [(None, "a b", None, None), (None, "a b", None, None), (None, None, None, None), (3, "", "en", ""), (4, "x y z", "en", "s")]
    rows += [(5, "q " * 11, "en", "s")] * 40 + [(5, "r " * 7, "en", "s")] * 3
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(ascii_words(text))
    expected = plain_targets(sizes)
    assert {r.source: r.target for r in got} == pytest.approx(expected)
    assert abs(sum(r.taken for r in got if r.source == "s") - expected["s"]) <= 6
    assert mixed(spark, []) == []


def test_mixture_repeats_documents(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), "en", rng.choice("aab")) for i in range(60)] + [(7, "same text", "en", "b")] * 9
    docs = docs_of(spark, rows)
    plan = balanced_mix.mix_plan(docs)
    out = balanced_mix.mixture(docs, plan)
    assert out.columns == docs.columns
    wanted = Counter()
    for r in balanced_mix.per_row(plan).collect():
        wanted[r.doc_id, r.source, r["size"]] += r.copies
    found = Counter((r.doc_id, r.source, len(ascii_words(r.text))) for r in out.collect())
    assert found == +wanted


def test_no_share_above_the_cap(spark):
    with pytest.raises(ValueError):
        balanced_mix.mix_plan(docs_of(spark, []), share=2.5)


# --- audit ----------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """Apply the filters one after the other, in every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang, _ in rows:
        text = text or ""
        words = ascii_words(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and least[text] < i,
        }
        docs.append((lang or "", {c for c, f in fails.items() if f}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[1]]
                kept = [d for d in left if c not in d[1]]
                failing = sum(c in d[1] for d in mine)
                alone = sum(d[1] == {c} for d in mine)
                out[part, order, step] = [len(kept), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)]
                total[c] += len(gone)
                left = kept
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


LABELS = "doc_id long, quality int, toxic int, id long, good int"


def audited(spark, rows, labels):
    frame = spark.createDataFrame([(*r, 1, 1) for r in labels], LABELS)
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in filter_audit.audit(docs_of(spark, rows), frame).collect()}


def test_audit_equals_filtering_in_every_order(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(120):
        words = [rng.choice(["a", "B", "c\t", "ä", "x#", "Wort"]) + str(rng.randrange(rng.choice([3, 900]))) for _ in range(rng.choice([3, 199, 200, 350]))]
        texts.append(rng.choice(texts) if texts and rng.random() < 0.4 else rng.choice([None, "", " \n", " ".join(words), " ".join(words).lower()]))
    rows = [(rng.choice([None, i, i, i, i // 3]), t, rng.choice([None, "", "en", "de"]), "s") for i, t in enumerate(texts)]
    rows += rows[:15] + [(500 + i, "one long text " * 100, "en", "s") for i in range(60)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    assert audited(spark, rows, labels) == plain_audit(rows, labels)


def test_audit_of_few_or_no_rows(spark):
    assert audited(spark, [], []) == {}
    one = audited(spark, [(1, "A " * 300_000, None, None)], [(1, 1, 1)])
    assert len(one) == 600 and one["", "ABCDE", 2] == [0, 1, 0, 0, 1, 1, 60] and one["", "CABDE", 1] == [0, 1, 0, 0, 1, 1, 60]


def test_audit_step_contraction_covers_all_orders():
    assert len(set(filter_audit.orders())) == math.factorial(5)


# --- importance -----------------------------------------------------------------------------------------------


def plain_words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_buckets(text):
    words = plain_words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain_resample(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(plain_buckets(text))
    for text in target:
        t.update(plain_buckets(text))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)}
    out = []
    for i, text in rows:
        found = plain_buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, len(plain_words(text))))
    eligible = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = defaultdict(list)
    for k, r in enumerate(eligible[: 25 * len(eligible) // 100], 1):
        ranks[r].append(k)
    return sorted(((*r[:4], ranks[r].pop(0) if ranks[r] else None) for r in out), key=str)


def ranked(spark, rows, target, **options):
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in rows])
    df = importance.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int"), **options)
    return docs, df, sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def test_resample_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 40)
    rng = random.Random(4)
    vocabulary = ["Alpha", "beta", "gämma", "ÄÖ", "x1", "12", "日本", "d"]
    join = [" ", "  ", ", ", "\x00", "_", "\n"]
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 19, 20, 21, 60])
        rows.append((rng.choice([i, i, i, None, i // 2]), "".join(rng.choice(vocabulary) + rng.choice(join) for _ in range(n))))
    rows += [(7, None), (8, ""), (9, " ,. "), (10, "w" * 500)] + [(600, "beta d 12 " * 30)] * 40
    target = ["beta d 12 x1 alpha", None, "gämma; beta"]
    docs, df, got = ranked(spark, rows, target)
    assert got == plain_resample(rows, target)
    drawn = Counter(r.doc_id for r in importance.drawn_documents(docs, df).collect())
    assert set(drawn) == {r[0] for r in got if r[4] is not None} and importance.drawn_documents(docs, df).columns == docs.columns


def test_resample_without_target_or_documents(spark):
    rows = [(i, "some words here " * 10) for i in range(9)]
    assert ranked(spark, rows, [])[2] == plain_resample(rows, [])
    assert ranked(spark, [], ["a b"])[2] == []


def test_long_text_is_cut_between_words(monkeypatch):
    text = "ab  Cd-é " * 60_000
    whole = importance.bucket_counts(text)
    monkeypatch.setattr(importance, "PIECE", 1000)
    assert importance.bucket_counts(text) == whole and whole[:2] == (180_000, 359_999)


def test_registered_resample_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    got = sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in queries.QUERIES["op13_importance_resampling"](spark, FOLDER).collect()), key=str)
    assert got == plain_resample(docs, items)


def test_registered_mix_equals_plain_targets(spark):
    docs = table(spark, FOLDER, "documents").collect()
    sizes, source = Counter(), {}
    for r in docs:
        sizes[r.source] += len(ascii_words(r.text))
        source[r.doc_id] = r.source
    expected = plain_targets(sizes)
    taken = Counter()
    for r in queries.QUERIES["op11_source_mix"](spark, FOLDER).collect():
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(expected[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= max(20, 0.01 * t) for s, t in expected.items())
