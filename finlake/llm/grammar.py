"""Weighted finite-state transducers over classes of words, and their composition.

A transducer reads one class of word at a time, moves between its states, puts out a class and adds a
weight. Several are composed into one machine, in which the output of each is the input of the next;
its states are the reachable tuples of states, so a clause is scored in one walk.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "other", "insult", "threat", "target", "negation", "report"
#: What an insult or a threat becomes once it is negated or reported.
DENIED, QUOTED = "denied", "quoted"
AIMED = "aimed"
CLASSES = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)


@dataclass
class Transducer:
    """``arcs[state, class] = (next state, class put out, factor)``; without an arc: back to state 0, class as it is.

    The factor applies to the weight of the word that is read.
    """

    arcs: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def step(self, state: int, read: str) -> tuple[int, str, float]:
        return self.arcs.get((state, read), (0, read, 1.0))


def _window(opener: str, scope: int, changes: dict[str, tuple[str, float]]) -> Transducer:
    """After an opener, for ``scope`` words, changes classes; an opener begins anew."""
    machine = Transducer()
    for state in range(scope + 1):
        machine.arcs[state, opener] = (scope, opener, 1.0)
        for read in (*CLASSES, DENIED, QUOTED):
            if read != opener and state:
                put, factor = changes.get(read, (read, 1.0))
                machine.arcs[state, read] = (state - 1, put, factor)
    return machine


def negation(scope: int = 3, factor: float = 0.25) -> Transducer:
    """"not an idiot": an insult or threat soon after a negation counts for less."""
    return _window(NEGATION, scope, {INSULT: (DENIED, factor), THREAT: (DENIED, factor)})


def reported(scope: int = 8, factor: float = 0.5) -> Transducer:
    """"she said he is an idiot": what is reported counts for less."""
    return _window(REPORT, scope, {INSULT: (QUOTED, factor), THREAT: (QUOTED, factor), DENIED: (DENIED, factor)})


def target(scope: int = 4, factor: float = 1.5) -> Transducer:
    """"you are an idiot": an insult or threat aimed at someone counts for more."""
    return _window(TARGET, scope, {INSULT: (AIMED, factor), THREAT: (AIMED, factor)})


def series(factor: float = 1.25) -> Transducer:
    """Insults and threats that follow each other in a clause strengthen each other."""
    machine, scored = Transducer(), (INSULT, THREAT, AIMED)
    for read in (*CLASSES, DENIED, QUOTED, AIMED):
        machine.arcs[0, read] = (int(read in scored), read, 1.0)
        machine.arcs[1, read] = (1, read, factor if read in scored else 1.0)
    return machine


class Grammar:
    """The composition of transducers, made ahead over all states that can be reached."""

    def __init__(self, parts: Iterable[Transducer]):
        parts = list(parts)
        start = (0,) * len(parts)
        self.arcs: dict[tuple[int, str], tuple[int, str, float]] = {}
        number, todo = {start: 0}, [start]
        while todo:
            states = todo.pop()
            for read in CLASSES:
                put, factor, following = read, 1.0, []
                for machine, state in zip(parts, states):
                    after, put, by = machine.step(state, put)
                    following.append(after)
                    factor *= by
                key = tuple(following)
                if key not in number:
                    number[key] = len(number)
                    todo.append(key)
                self.arcs[number[states], read] = (number[key], put, factor)

    def clause(self, words: Iterable[tuple[str, float]]) -> float:
        """The score of a clause: the weights of its insults and threats, as the machine changes them."""
        state = total = 0
        for read, weight in words:
            state, put, factor = self.arcs[state, read]
            if put not in (OTHER, TARGET, NEGATION, REPORT):
                total += weight * factor
        return total


def toxicity_grammar() -> Grammar:
    return Grammar((negation(), reported(), target(), series()))
