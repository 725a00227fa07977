"""Grammar inference: a probabilistic automaton from example strings, by merging compatible states of their prefix tree.

A state of the prefix tree stands for the strings that share a prefix, with counts of what comes next. Two states are
compatible if the shares of each next symbol, and of ending, do not differ by more than Hoeffding's bounds allow, and
the same holds for the states behind them. States are looked at from the start on, those most often passed first: one that is
compatible with a state kept so far is merged into it, else it is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The characters of candidates; all others count as one symbol more.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SYMBOLS = len(ALPHABET) + 1
_NUMBER = np.full(256, len(ALPHABET), np.uint8)
_NUMBER[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))

#: Chance that two states of one distribution are told apart, and the weight of the even distribution in each state.
ALPHA, SMOOTHING = 0.01, 0.5


@dataclass
class Automaton:
    """For each state and symbol the state that follows and the log of its probability; the last column is the end."""

    follows: np.ndarray
    logs: np.ndarray

    def likelihoods(self, strings: list[str]) -> np.ndarray:
        """Log-likelihood of each string, all of them stepped through at once, a symbol a step."""
        sizes = np.array([len(s) for s in strings], np.int64)
        longest_first = np.argsort(-sizes, kind="stable")
        ends = np.cumsum(sizes)
        symbols = _NUMBER[np.frombuffer("".join(strings).encode("ascii", "replace"), np.uint8)]
        starts, sizes = (ends - sizes)[longest_first], sizes[longest_first]
        state, total = np.zeros(len(strings), np.int32), np.zeros(len(strings))
        for step in range(int(sizes[0]) if len(sizes) else 0):
            going = int(np.searchsorted(-sizes, -step, "left"))
            read = symbols[starts[:going] + step]
            total[:going] += self.logs[state[:going], read]
            state[:going] = self.follows[state[:going], read]
        total += self.logs[state, SYMBOLS]
        out = np.empty(len(strings))
        out[longest_first] = total
        return out


class _Tree:
    """The prefix tree of the examples, and what becomes of it as states are merged."""

    def __init__(self, strings: list[str]) -> None:
        self.passed, self.ended = [0], [0]
        self.next: list[dict[int, int]] = [{}]
        self.counts: list[dict[int, int]] = [{}]
        for string in strings:
            at = 0
            self.passed[0] += 1
            for symbol in _NUMBER[np.frombuffer(string.encode("ascii", "replace"), np.uint8)].tolist():
                if symbol not in self.next[at]:
                    self.next[at][symbol] = len(self.passed)
                    self.passed.append(0)
                    self.ended.append(0)
                    self.next.append({})
                    self.counts.append({})
                self.counts[at][symbol] = self.counts[at].get(symbol, 0) + 1
                at = self.next[at][symbol]
                self.passed[at] += 1
            self.ended[at] += 1

    def compatible(self, one: int, other: int, bound: float) -> bool:
        pairs = [(one, other)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.passed[a], self.passed[b]
            most = bound * (n**-0.5 + m**-0.5)
            if abs(self.ended[a] / n - self.ended[b] / m) > most:
                return False
            x, y = self.counts[a], self.counts[b]
            for symbol in x.keys() | y.keys():
                if abs(x.get(symbol, 0) / n - y.get(symbol, 0) / m) > most:
                    return False
            pairs += [(self.next[a][s], self.next[b][s]) for s in x.keys() & y.keys()]
        return True

    def merge(self, into: int, other: int) -> None:
        pairs = [(into, other)]
        while pairs:
            a, b = pairs.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for symbol, n in self.counts[b].items():
                self.counts[a][symbol] = self.counts[a].get(symbol, 0) + n
                if symbol in self.next[a]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
                else:
                    self.next[a][symbol] = self.next[b][symbol]


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of the strings; their order does not matter. Without strings every text is equally likely."""
    tree = _Tree(sorted(strings))
    bound = float(np.sqrt(0.5 * np.log(2 / alpha)))
    kept, places = [0], {0}
    while True:
        # States behind a kept one that are not kept themselves hang on it alone.
        waiting = [(-tree.passed[n], at, s, n) for at in kept for s, n in tree.next[at].items() if n not in places]
        if not waiting:
            break
        _, at, symbol, state = min(waiting)
        same = next((k for k in kept if tree.compatible(k, state, bound)), None)
        if same is None:
            kept.append(state)
            places.add(state)
        else:
            tree.next[at][symbol] = same
            tree.merge(same, state)
    number = {state: k for k, state in enumerate(kept)}
    follows = np.zeros((len(kept), SYMBOLS), np.int32)
    counts = np.zeros((len(kept), SYMBOLS + 1))
    for state, k in number.items():
        for symbol, behind in tree.next[state].items():
            follows[k, symbol] = number[behind]
            counts[k, symbol] = tree.counts[state][symbol]
        counts[k, SYMBOLS] = tree.ended[state]
    shares = (counts + SMOOTHING / (SYMBOLS + 1)) / (counts.sum(1, keepdims=True) + SMOOTHING)
    return Automaton(follows, np.log(shares))
