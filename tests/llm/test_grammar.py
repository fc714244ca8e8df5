"""The composed machine against its five parts in a row, and against reading a clause with flags."""

import random

import numpy as np
import pytest

from supplyloom.llm import toxicity


def by_flags(letters):
    """What a clause says, told with flags instead of machines."""
    written = np.zeros(toxicity.KINDS)
    negated = reported = aimed = False
    threat = 0.0
    for letter, weight in letters:
        if letter == ".":
            negated = reported = aimed = False
            threat = 0.0
        elif letter == "N":
            negated = True
        elif letter == "R":
            reported = True
        elif letter == "T":
            aimed = True
            written[toxicity.THREAT] += 0.0 if negated else threat
            threat = 0.0
        elif letter == "H":
            threat = toxicity.REPORTED_SHARE if reported else 1.0
            if aimed and not negated:
                written[toxicity.THREAT] += threat
                threat = 0.0
        else:
            raised = weight * (toxicity.AIMED_SHARE if aimed else 1.0)
            if negated:
                written[toxicity.NEGATED] += raised * toxicity.NEGATED_SHARE
            elif reported:
                written[toxicity.REPORTED] += raised * toxicity.REPORTED_SHARE
            else:
                written[toxicity.AIMED if aimed else toxicity.PLAIN] += raised
    return written


def sequences():
    rng = random.Random(9)
    for _ in range(3000):
        yield [(c, rng.choice([0.5, 2.0]) if c == "I" else 1.0) for c in rng.choices(toxicity.LETTERS, k=rng.randrange(15))]


def test_composed_machine_equals_its_parts_in_a_row():
    for letters in sequences():
        out = letters
        for part in toxicity.CHAIN:
            out = part.run(out)
        composed = toxicity.GRAMMAR.run(letters)
        assert [c for c, _ in composed] == [c for c, _ in out]
        assert [w for _, w in composed] == pytest.approx([w for _, w in out])


def test_composed_machine_equals_flags():
    for letters in sequences():
        symbols = {str(i): symbol for i, symbol in enumerate(letters)}
        assert toxicity.read_clauses(list(symbols), symbols) == pytest.approx(by_flags(letters))


def test_composition_is_associative_and_small():
    a, b, c = toxicity.CHAIN[:3]
    letters = toxicity.LETTERS
    one = toxicity.compose(toxicity.compose(a, b, letters), c, letters)
    middle = letters + letters.lower() + "JGit"
    two = toxicity.compose(a, toxicity.compose(b, c, middle), letters)
    for sequence in sequences():
        assert one.run(sequence) == two.run(sequence)
    assert len(toxicity.TABLE) <= 24 and all(set(row) == set(letters) for row in toxicity.TABLE)
