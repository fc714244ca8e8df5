"""Toxicity by a weighted finite-state pattern grammar over the clauses of a text.

Five small transducers read a clause from left to right, each the output of the one before: negation, reported speech, targets,
threats and insults. They are tables of moves (state and letter to state, letter and factor) and are composed once into the
machine that reads the texts; its states are what has been seen of a clause. Negation and reported speech mark
what follows them in the clause, a target raises the insults after it, a threat counts once it is aimed at somebody. The
written weights, kept apart by kind, are the features of a logistic model; an insult without any target in front of it is a kind
of its own, whose weight the model learns.

Insult words and stems, with their weights, are learned from labelled texts, so the grammar works in languages for
which there is no word list. Threats, targets, negators and reporting verbs are closed lists.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.common import hash_share

# Function words of the grammar in English, German, French and Spanish.
THREATS = frozenset("kill hurt destroy beat murder attack shoot stab töte töten schlage verletze tuer tue frapper matar mato golpear".split())
TARGETS = frozenset("you your yourself they them he she him her du dich dir ihr euch tu toi vous ils elle tú ti usted ellos ella".split())
NEGATORS = frozenset("not no never isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca jamás".split())
REPORTS = frozenset("said says say wrote writes claimed reported quoted sagte sagt schrieb berichtet dit dits écrit déclaré dijo dice escribió".split())

WORD_OR_STOP = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:,\n\"«»“”()]")
PLAIN, AIMED, NEGATED, REPORTED, THREAT = range(5)
KINDS = 5
STEM_LENGTHS = (4, 5, 6)
NEGATED_SHARE, REPORTED_SHARE, AIMED_SHARE = 0.3, 0.5, 1.3
TOXIC_FROM = 0.7
TRAIN_ROWS = 6_000  # bound of the labelled rows of each class that the model is fitted on
SYMBOLS = 200_000  # words whose class a task remembers


def _forms(word: str) -> list[str]:
    """The word itself and its stems, which end with an asterisk."""
    return [word, *(word[:n] + "*" for n in STEM_LENGTHS if len(word) >= n)]


class _Symbols(dict):
    """Word to (class letter, insult weight); forgets everything when it is full."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[str, float]:
        weight = max((self.lexicon.get(f, 0.0) for f in _forms(word)), default=0.0)
        if weight > 0:
            symbol = ("I", weight)
        elif word in THREATS:
            symbol = ("H", 1.0)
        elif word in TARGETS:
            symbol = ("T", 1.0)  # the weight a waiting threat is written with
        elif word in NEGATORS:
            symbol = ("N", 0.0)
        elif word in REPORTS:
            symbol = ("R", 0.0)
        elif len(word) == 1 and not word.isalpha():
            symbol = (".", 0.0)
        else:
            symbol = ("", 0.0)
        if len(self) >= SYMBOLS:
            self.clear()
        self[word] = symbol
        return symbol


@dataclass(frozen=True)
class Transducer:
    """Moves of a machine that starts in state 0: (state, letter) to (state, letter written, factor of its weight).

    A letter without a move is passed on unchanged; writing '' drops it.
    """

    moves: Mapping[tuple[int, str], tuple[int, str, float]]

    def step(self, state: int, letter: str) -> tuple[int, str, float]:
        return self.moves.get((state, letter), (state, letter, 1.0))

    def run(self, letters: Iterable[tuple[str, float]]) -> list[tuple[str, float]]:
        """What it writes, letter by letter with weights."""
        state, out = 0, []
        for letter, weight in letters:
            state, written, factor = self.step(state, letter)
            if written:
                out.append((written, weight * factor))
        return out


def compose(first: Transducer, second: Transducer, letters: str) -> Transducer:
    """One machine that writes what ``second`` writes on reading the output of ``first``, for inputs of these letters."""
    numbers, moves, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = pair = todo.pop()
        for letter in letters:
            to_a, middle, factor = first.step(a, letter)
            to_b, written, more = second.step(b, middle) if middle else (b, "", 1.0)
            if (to_a, to_b) not in numbers:
                numbers[to_a, to_b] = len(numbers)
                todo.append((to_a, to_b))
            moves[numbers[pair], letter] = (numbers[to_a, to_b], written, factor * more)
    return Transducer(moves)


# Letters read: I insult, H threat, T target, N negator, R reporting verb, . end of a clause.
LETTERS = "IHTNR."
# after a negator until the clause ends: insults, targets and threats in small letters
NEGATION = Transducer(
    {(s, "N"): (1, "", 1.0) for s in (0, 1)}
    | {(1, letter): (1, letter.lower(), 1.0) for letter in "ITH"}
    | {(1, "."): (0, ".", 1.0)}
)
# after a reporting verb: J reported insult, G reported threat
REPORTED_SPEECH = Transducer(
    {(s, "R"): (1, "", 1.0) for s in (0, 1)} | {(1, "I"): (1, "J", 1.0), (1, "H"): (1, "G", 1.0), (1, "."): (0, ".", 1.0)}
)
# after a target: A aimed insult, K and L threats that are aimed already
TARGETING = Transducer(
    {(0, letter): (1, letter, 1.0) for letter in "Tt"}
    | {(1, "I"): (1, "A", AIMED_SHARE), (1, "J"): (1, "J", AIMED_SHARE), (1, "i"): (1, "i", AIMED_SHARE)}
    | {(1, "H"): (1, "K", 1.0), (1, "G"): (1, "L", 1.0), (1, "."): (0, ".", 1.0)}
)
# a threat waits (state 1, reported 2) for its target, which a negation in between spoils: X threat
THREATENING = Transducer(
    {(s, "H"): (1, "", 1.0) for s in range(3)}
    | {(s, "G"): (2, "", 1.0) for s in range(3)}
    | {(s, "K"): (0, "X", 1.0) for s in range(3)}
    | {(s, "L"): (0, "X", REPORTED_SHARE) for s in range(3)}
    | {(0, "T"): (0, "", 1.0), (1, "T"): (0, "X", 1.0), (2, "T"): (0, "X", REPORTED_SHARE)}
    | {(s, letter): (0, written, 1.0) for s in range(3) for letter, written in (("t", ""), (".", "."))}
    | {(s, "h"): (s, "", 1.0) for s in range(3)}
)
# what is written in the end, by kind
INSULTING = Transducer({(0, "."): (0, "", 1.0), (0, "i"): (0, "i", NEGATED_SHARE), (0, "J"): (0, "J", REPORTED_SHARE)})
WRITTEN = {"I": PLAIN, "A": AIMED, "i": NEGATED, "J": REPORTED, "X": THREAT}

CHAIN = (NEGATION, REPORTED_SPEECH, TARGETING, THREATENING, INSULTING)
GRAMMAR = reduce(lambda a, b: compose(a, b, LETTERS), CHAIN)


def _table(machine: Transducer) -> list[dict[str, tuple[int, int, float]]]:
    """Per state and letter the next state, the kind written (-1: nothing) and its factor."""
    rows: list[dict[str, tuple[int, int, float]]] = [{} for _ in range(1 + max(s for s, _ in machine.moves))]
    for (state, letter), (to, written, factor) in machine.moves.items():
        rows[state][letter] = (to, WRITTEN[written] if written else -1, factor)
    return rows


TABLE = _table(GRAMMAR)


def read_clauses(tokens: Sequence[str], symbols: Mapping[str, tuple[str, float]]) -> np.ndarray:
    """Run the composed machine over all clauses; per kind the sum of the weights it wrote."""
    written = [0.0] * KINDS
    row = TABLE[0]
    for letter, weight in filter(_speaks, map(symbols.__getitem__, tokens)):
        to, kind, factor = row[letter]
        row = TABLE[to]
        if kind >= 0:
            written[kind] += factor * weight
    return np.array(written)


def _speaks(symbol: tuple[str, float]) -> bool:
    return symbol[0] != ""


@dataclass
class Grammar:
    """Insult lexicon and the logistic weights over the kinds of match (last: bias)."""

    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(KINDS + 3))

    def features(self, text: str | None, symbols: _Symbols) -> np.ndarray:
        tokens = WORD_OR_STOP.findall((text or "").lower())
        written = read_clauses(tokens, symbols)
        total = written.sum()
        return np.concatenate([np.log1p(written), [math.log1p(total), total > 0, 1.0]])

    def score(self, text: str | None, symbols: _Symbols) -> float:
        return float(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, float(self.features(text, symbols) @ self.weights))))))


def learn_lexicon(texts: list[str], toxic: list[int], odds: float = 3.0) -> dict[str, float]:
    """Words and stems that stand in toxic texts far more often than in others, with their log odds ratio.

    A form must also be too one-sided for chance: less than one form of the whole sample may be expected to be so.
    """
    counts = [Counter(), Counter()]
    for text, label in zip(texts, toxic, strict=True):
        words = set(WORD_OR_STOP.findall(text.lower()))
        counts[label].update({f for w in words if len(w) > 1 for f in _forms(w)})
    n_toxic, n_clean = max(1, sum(toxic)), max(1, len(toxic) - sum(toxic))
    share = math.log(n_toxic / (n_toxic + n_clean)), math.log(n_clean / (n_toxic + n_clean))
    forms = math.log(len(counts[0].keys() | counts[1].keys()) + 1)
    found = {}
    for form, seen in counts[1].items():
        if seen < 4:
            continue
        clean = counts[0][form]
        ratio = math.log((seen + 0.5) / n_toxic) - math.log((clean + 0.5) / n_clean)
        ways = math.lgamma(seen + clean + 1) - math.lgamma(seen + 1) - math.lgamma(clean + 1)
        if ratio >= odds and ways + seen * share[0] + clean * share[1] + forms < 0:
            found[form] = ratio
    return found


def fit(texts: list[str], toxic: list[int]) -> Grammar:
    """Fit lexicon and weights. Half of the texts give the lexicon for the other half, so that the weights do not
    learn from words that merely happened to stand in their own texts; the final lexicon comes from all of them."""
    grammar = Grammar(weights=np.append(np.zeros(KINDS + 2), -30.0))
    if not any(toxic) or all(toxic):
        return grammar
    rows, labels = [], []
    for part in (0, 1):
        own = range(part, len(texts), 2)
        other = range(1 - part, len(texts), 2)
        lexicon = learn_lexicon([texts[i] for i in other], [toxic[i] for i in other])
        half, symbols = Grammar(lexicon), _Symbols(lexicon)
        rows += [half.features(texts[i], symbols) for i in own]
        labels += [toxic[i] for i in own]
    x, y = np.array(rows), np.array(labels, dtype=float)
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, 1.0), 1e-6)
    for _ in range(30):  # Newton steps of the regularised logistic loss
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
    return Grammar(learn_lexicon(texts, toxic), w)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, parts: int = 3, held_out: int = 1) -> Grammar:
    """Fit on at most ``rows`` labelled documents of each class whose crc32(doc_id) mod ``parts`` is not ``held_out``.

    They are those with the smallest hash of the id, so the choice does not depend on partitions. An id with contradicting labels
    counts as toxic, of several texts under one id the smallest is read. Rows without text, id or label take no part;
    without both classes the model finds nothing toxic.
    """
    known = labels.filter(hash_share(F.col("doc_id"), parts) != held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(rows) for c in (0, 1)]
    wanted = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * rows ids
    sample = docs.select("doc_id", "text").filter("text is not null").join(wanted, "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # one row for each id
    texts, toxic = [], []
    for row in sorted(sample.collect(), key=lambda r: (r.doc_id, r.text)):
        texts.append(row.text)
        toxic.append(int(row.toxic))
    return fit(texts, toxic)


def scores(grammar: Grammar, text: Column, spark) -> Column:
    """Score 0 to 1 of every whole text; NULL and empty texts get the score of a text without any match."""
    shared = spark.sparkContext.broadcast(grammar)  # bounded: lexicon and weights of a bounded sample

    @F.pandas_udf("double")
    def toxicity(batch: pd.Series) -> pd.Series:
        model = shared.value
        symbols = _remembered(model)
        return pd.Series([model.score(t, symbols) for t in batch], dtype="float64")

    return toxicity(text)


def judge(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a NULL id is not held out and takes no part in training."""
    grammar = train(docs, labels, parts=parts, held_out=held_out)
    return docs.select(
        "doc_id",
        F.coalesce(hash_share(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out"),
        scores(grammar, F.col("text"), docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def _remembered(model: Grammar) -> _Symbols:
    """One table of word classes for each worker process and model."""
    if not hasattr(model, "symbols"):
        model.symbols = _Symbols(model.lexicon)
    return model.symbols
