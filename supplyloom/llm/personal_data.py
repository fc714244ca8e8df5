"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

The base patterns always count. Beyond them, a loose pattern for each kind proposes further candidates (numbers
in groups, addresses with a spelt-out at sign, long mixed strings that may be secrets, ...). Regex, gazetteer and context
labelers vote for, against or abstain on every candidate, base ones included and under the same rules; that a span is a base one is no
vote. The candidates of the corpus are counted in Spark by kind, votes and form; for each kind expectation-maximisation on
these counts estimates how reliable each labeler is, without labels. The posteriors train the span classifier of the kind, a
logistic model on the votes and the form of the span (length, groups of digits, separators), which decides on the added spans.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
# Base patterns of the contract. Guards in front keep them linear on long runs without changing what they match.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MAYBE = re.compile(r"[0-9@]| at | AT |\(at\)|\[at\]")
OPENING, CLOSING = frozenset(" \t\r\n\"'([{<:=,;"), frozenset(" \t\r\n\"')]}>.,;:!?")
# Loose candidates of the method
LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?:(?: ?\.| ?\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}){1,4}")
LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[?\.\]? ?[0-9]{1,3}){3}(?![0-9.])")
LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,5}\)?){1,4}(?![0-9A-Za-z])")
LOOSE_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{3,6}){2,4}(?![0-9A-Za-z])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}")
LOOSE = (("email", LOOSE_EMAIL), ("ip", LOOSE_IP), ("card", LOOSE_CARD), ("phone", LOOSE_PHONE), ("secret", SECRET))
# Gazetteer and context words: fixed values.
DOMAINS = frozenset("com org net edu gov mail example de fr es io info".split())
CALLING = frozenset("00 01 02 030 040 555 800 900".split())
CONTEXT = {
    "email": frozenset("email e-mail mail mailto contact write correo courriel".split()),
    "ip": frozenset("ip host server address adresse login dirección".split()),
    "card": frozenset("card visa credit kreditkarte carte tarjeta payment iban".split()),
    "phone": frozenset("phone call tel telephone telefon mobile fax anruf appelez teléfono llame".split()),
    "secret": frozenset("token key apikey secret password passwd pwd credential credentials auth bearer private".split()),
}
AGAINST = frozenset("version page section isbn chapter figure order invoice id no nr commit checksum sha md5 hash uuid".split())
ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
REACH = 40  # characters of context on either side
LABELERS = ("shape", "gazetteer", "context", "edges", "against")
ACCEPT = 0.9
# form of a span: length, groups of digits and separators, each in a few steps
LENGTHS, GROUPS, SEPARATORS = (8, 12, 16, 24, 40), (1, 2, 4, 5), 3
FORMS = (len(LENGTHS) + 1, len(GROUPS) + 1, SEPARATORS)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from the at signs so that long words cost nothing."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            end = found.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Base spans, and loose ones that touch none of them nor an earlier loose one."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    # spans of loose candidates do not overlap, so their neighbours by start tell all; base spans of two kinds may
    taken = sorted((a, b) for _, a, b in base)
    reach = max((b - a for a, b in taken), default=0)
    for kind, pattern in LOOSE:
        for m in pattern.finditer(text):
            a, b = m.span()
            at = bisect_left(taken, (b, b))
            free = True
            while at and taken[at - 1][0] + reach > a:
                at -= 1
                if taken[at][1] > a:
                    free = False
                    break
            if free:
                out.append((kind, a, b, False))
                insort(taken, (a, b))
                reach = max(reach, b - a)
    return out


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """One vote of each labeler: 1 for, -1 against, 0 abstains."""
    span = text[start:end]
    digits = _digits(span)
    front = text[max(0, start - REACH) : start]
    before = [w.lower() for w in WORD.findall(front)]
    after = [w.lower() for w in WORD.findall(text[end : end + REACH])]
    near = set(before[-4:] + after[:2])
    gazetteer = 0
    if kind == "email":
        shape = 1 if DOMAIN.search(span) or "dot" in span else -1
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", span.lower())[-1] in DOMAINS else -1
    elif kind == "ip":
        shape = 1 if all(_small(p) for p in re.findall("[0-9]+", span)) else -1
    elif kind == "card":
        shape, gazetteer = (1 if 13 <= len(digits) <= 19 and luhn(digits) else -1), (1 if digits[:1] in ("3", "4", "5", "6") else -1)
    elif kind == "phone":
        shape = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = 1 if CALLING & set(re.findall("[0-9]+", span)) else 0
    else:
        letters = sum(c.isalpha() for c in span)
        shape = 1 if len(span) >= 20 and min(letters, len(digits)) * 6 >= len(span) else -1
        gazetteer = 1 if ASSIGNED.search(front) else -1
    context = 1 if near & CONTEXT[kind] else -1 if kind == "secret" else 0
    alone = (not front or front[-1] in OPENING) and (end == len(text) or text[end] in CLOSING)
    against = -1 if set(before[-2:]) & AGAINST else 0
    return shape, gazetteer, context, 1 if alone else -1, against


def form(span: str) -> tuple[int, ...]:
    """Steps of length, groups of digits and separators (none, one kind, several)."""
    groups = len(re.findall("[0-9]+", span))
    return (
        sum(len(span) >= n for n in LENGTHS),
        sum(groups >= n for n in GROUPS),
        min(len({c for c in span if not c.isalnum()}), SEPARATORS - 1),
    )


@dataclass
class Reliability:
    """Prior of a true span, and per labeler the probabilities of its votes (-1, 0, 1) for false and true spans."""

    prior: float = 0.5
    tables: np.ndarray = field(default_factory=lambda: np.tile([[0.4, 0.4, 0.2], [0.2, 0.4, 0.4]], (len(LABELERS), 1, 1)))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        if not len(patterns):
            return np.zeros(0)
        logs = np.log(self.tables)
        each = np.stack([logs[j, :, patterns[:, j] + 1] for j in range(len(LABELERS))]).sum(axis=0)
        odds = each[:, 1] - each[:, 0] + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> Reliability:
    """EM over vote patterns and their counts, with one pseudo-count so that no probability is zero."""
    model = Reliability()
    if not len(patterns):
        return model
    for _ in range(rounds):
        true = model.posterior(patterns)
        share = np.stack([(1 - true) * counts, true * counts])
        model.prior = float(np.clip(share[1].sum() / counts.sum(), 0.01, 0.99))
        for j in range(len(LABELERS)):
            for v in (-1, 0, 1):
                hit = patterns[:, j] == v
                model.tables[j, :, v + 1] = share[:, hit].sum(axis=1) + 1.0
        model.tables /= model.tables.sum(axis=2, keepdims=True)
    return model


def features(pattern: tuple[int, ...], steps: tuple[int, ...]) -> np.ndarray:
    """Inputs of a span classifier: every vote as two indicators, the form in indicators, a bias."""
    shape = [float(step == n) for step, size in zip(steps, FORMS, strict=True) for n in range(size)]
    return np.array([float(v > 0) for v in pattern] + [float(v < 0) for v in pattern] + shape + [1.0])


def train_classifier(patterns: np.ndarray, forms: np.ndarray, counts: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Logistic regression of one kind on the posteriors, weighted by count, by Newton steps."""
    width = 2 * len(LABELERS) + sum(FORMS) + 1
    w = np.zeros(width)
    if not len(patterns):
        w[-1] = -math.inf
        return w
    x = np.array([features(p, f) for p, f in zip(patterns, forms, strict=True)])
    weight = counts / counts.sum() * 1000
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(width)
        w -= np.linalg.solve(hessian, x.T @ (weight * (p - truth)) + 0.1 * w)
    return w


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,votes:array<int>,form:array<int>>>"


def candidate_spans(text: Column) -> Column:
    """All candidates of every whole text with their votes; offsets in code points, end exclusive."""

    @F.pandas_udf(SPANS)
    def spans(batch: pd.Series) -> pd.Series:
        out = []
        for text in batch:
            found = candidates(text) if text and MAYBE.search(text) else []
            found.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
            out.append(
                [
                    {"kind": k, "start": a, "end": b, "base": c, "votes": list(votes(text, k, a, b)), "form": list(form(text[a:b]))}
                    for k, a, b, c in found
                ]
            )
        return pd.Series(out)

    return spans(text)


def train(spans: DataFrame) -> tuple[dict[str, Reliability], dict[str, np.ndarray]]:
    """Reliabilities and span classifier of every kind from all candidates (``spans``).

    What reaches the driver is counts by kind, votes and form, at most 5 * 3^5 * 90 rows whatever the corpus.
    """
    rows = spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.form").count().collect()
    rows.sort(key=lambda r: (r.kind, r.votes, r.form))
    reliability, weights = {}, {}
    for kind in KINDS:
        mine = [r for r in rows if r.kind == kind]
        patterns = np.array([r.votes for r in mine], dtype=int).reshape(len(mine), len(LABELERS))
        forms = np.array([r.form for r in mine], dtype=int).reshape(len(mine), len(FORMS))
        counts = np.array([r["count"] for r in mine], dtype=float)
        reliability[kind] = estimate(patterns, counts)
        weights[kind] = train_classifier(patterns, forms, counts, reliability[kind].posterior(patterns))
    return reliability, weights


def accepted(weights: dict[str, np.ndarray], span: Column) -> Column:
    """Base spans, and candidates that the classifier of their kind gives ACCEPT or more."""
    n, found = len(LABELERS), span["base"]
    for kind, w in weights.items():
        if not np.isfinite(w).all():
            continue
        logit = F.lit(float(w[-1]))
        for j in range(n):
            logit += F.when(span["votes"][j] > 0, float(w[j])).when(span["votes"][j] < 0, float(w[n + j])).otherwise(0.0)
        at = 2 * n
        for j, size in enumerate(FORMS):
            logit += F.get(F.array(*[F.lit(float(x)) for x in w[at : at + size]]), span["form"][j])
            at += size
        found |= (span["kind"] == kind) & (logit >= math.log(ACCEPT / (1 - ACCEPT)))
    return found


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: the accepted spans (kind, start, end, base, votes, form) by kind and start.

    NULL and empty texts, and texts without a digit or at sign, have no spans. Rows are independent of each other.
    """
    from supplyloom.llm.common import staged

    rows = staged(docs.select(F.col(id_col).alias("doc_id"), candidate_spans(F.col(text_col)).alias("spans")))
    _, weights = train(rows)
    return rows.select("doc_id", F.filter("spans", lambda s: accepted(weights, s)).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Digest of ``find``: base counts by kind, digest of the base spans, all spans as text, their number, and how many were added.

    Repeated rows are rows of their own; columns beside id and text play no part.
    """
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    n_spans = F.size("spans").cast("long")
    return find(docs).select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        n_spans.alias("n_spans"), (n_spans - F.size(base)).alias("n_added"),
    )
