"""Probabilistic automata, learned by merging compatible states of a prefix tree."""

from __future__ import annotations

import math


class Automaton:
    """States with counts of visits, ends and transitions."""

    def __init__(self):
        self.visits: list[int] = [0]
        self.ends: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.uses: list[dict[str, int]] = [{}]

    def _state(self) -> int:
        self.visits.append(0)
        self.ends.append(0)
        self.next.append({})
        self.uses.append({})
        return len(self.visits) - 1

    def add(self, word: str) -> None:
        state = 0
        self.visits[0] += 1
        for c in word:
            self.uses[state][c] = self.uses[state].get(c, 0) + 1
            if c not in self.next[state]:
                self.next[state][c] = self._state()
            state = self.next[state][c]
            self.visits[state] += 1
        self.ends[state] += 1

    def _differ(self, a: int, b: int, bound: float) -> bool:
        n, m = self.visits[a], self.visits[b]
        room = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if abs(self.ends[a] / n - self.ends[b] / m) > room:
            return True
        both = self.uses[a].keys() | self.uses[b].keys()
        return any(abs(self.uses[a].get(c, 0) / n - self.uses[b].get(c, 0) / m) > room for c in both)

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """Hoeffding test on the two states and, in step, on all states that follow both."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(a, b, bound):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.uses[b].items():
                self.uses[a][c] = self.uses[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]


def learn(words: list[str], alpha: float = 0.05) -> Automaton:
    """Merge each state at the rim into the first compatible one that is settled, or settle it."""
    automaton = Automaton()
    for word in sorted(words):
        automaton.add(word)
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    settled, rim = [0], [(0, c) for c in sorted(automaton.next[0])]
    known = {0}
    while rim:
        rim.sort(key=lambda x: (-automaton.visits[automaton.next[x[0]][x[1]]], x))
        parent, c = rim.pop(0)
        state = automaton.next[parent][c]
        home = next((s for s in settled if automaton.compatible(s, state, bound)), None)
        if home is None:
            settled.append(state)
            known.add(state)
        else:
            automaton.next[parent][c] = home
            automaton.fold(home, state)
        rim = sorted({(s, x) for s in settled for x, to in automaton.next[s].items() if to not in known})
    return automaton


def logs(automaton: Automaton, floor: float = 1e-3) -> list[tuple[float, float, dict[str, tuple[int, float]]]]:
    """For each state reached: log2 of ending, of a letter never seen, and of each transition with its target."""
    out, number, todo = [], {0: 0}, [0]
    for state in todo:
        for c in sorted(automaton.next[state]):
            to = automaton.next[state][c]
            if to not in number:
                number[to] = len(todo)
                todo.append(to)
    for state in todo:
        n = max(1, automaton.visits[state])
        steps = {c: (number[to], math.log2((1 - floor) * automaton.uses[state][c] / n)) for c, to in automaton.next[state].items()}
        out.append((math.log2((1 - floor) * automaton.ends[state] / n + floor), math.log2(floor / 64), steps))
    return out
