"""Double-array tries: transitions of many states at once.

State ``s`` goes on by symbol ``d`` (0 to 255) to ``t = base[s] + d`` if
``check[t] == s``.  Two arrays hold the whole trie, a step of any number of
states is three array operations.  State 0 has no way on: the dead state.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALPHABET = 256
#: States with more ways on than this get a page of ``ALPHABET`` slots for themselves.
PAGED = 32
#: Slots for each way on that is placed by trial: three in four stay free, so few trials fail.
ROOM = 4


def digits_of(values: np.ndarray, digits: int) -> np.ndarray:
    """(values, digits): numbers in base ``ALPHABET``, the highest digit first."""
    shifts = 8 * np.arange(digits - 1, -1, -1, dtype=np.int64)
    return (np.asarray(values, dtype=np.int64)[:, None] >> shifts) & (ALPHABET - 1)


class Builder:
    """Adds the ways on of whole levels of states."""

    def __init__(self, states: int):
        """States 1 to ``states`` are there from the start."""
        self.base = np.zeros(states + 1 + ALPHABET, dtype=np.int32)
        self.check = np.full(states + 1 + ALPHABET, -1, dtype=np.int32)
        self.first = states + 1

    def _grow(self, slots: int) -> None:
        more = self.first + slots + ALPHABET - len(self.base)
        if more > 0:
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int32)])

    def add(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state after each (state, symbol); the pairs are distinct, and the states have no ways on yet."""
        order = np.lexsort((symbols, states))
        owner, symbol = states[order], symbols[order]
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))[: len(owner)]
        fan = np.diff(np.append(starts, len(owner)))
        bases = np.empty(len(starts), dtype=np.int64)
        paged = np.flatnonzero(fan > PAGED)
        bases[paged] = self.first + ALPHABET * np.arange(len(paged))
        low = self.first + ALPHABET * len(paged)
        open_ = np.flatnonzero(fan <= PAGED)
        room = ROOM * int(fan[open_].sum()) + ALPHABET
        self._grow(ALPHABET * len(paged) + room + ALPHABET)
        taken = np.zeros(room + ALPHABET, dtype=bool)
        rng = np.random.default_rng(len(owner))
        for least, most in ((9, PAGED), (3, 8), (2, 2), (1, 1)):
            left = open_[(fan[open_] >= least) & (fan[open_] <= most)]
            while len(left):
                bases[left] = rng.integers(0, room, len(left))
                of = np.repeat(np.arange(len(left)), fan[left])
                inside = np.arange(len(of)) - np.repeat(np.cumsum(fan[left]) - fan[left], fan[left])
                slots = bases[left][of] + symbol[starts[left][of] + inside]
                # A slot goes to the first that asks for it; who misses one asks for others.
                won = ~taken[slots]
                _, first = np.unique(slots, return_index=True)
                mine = np.zeros(len(slots), dtype=bool)
                mine[first] = True
                good = np.logical_and.reduceat(won & mine, np.cumsum(fan[left]) - fan[left])
                taken[slots[good[of]]] = True
                bases[left[good]] += low
                left = left[~good]
        after = np.repeat(bases, fan) + symbol
        self.base[owner[starts]] = bases
        self.check[after] = owner
        self.first = low + room + ALPHABET
        out = np.empty(len(after), dtype=np.int64)
        out[order] = after
        return out

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        self._grow(ALPHABET)
        return self.base, self.check


def advance(base: np.ndarray, check: np.ndarray, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The states after one symbol each; 0 where there is no way on."""
    after = base[states] + symbols
    return np.where(check[after] == states, after, 0)


def step_trie(states: np.ndarray, words: np.ndarray, n_states: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, last): a trie in which state ``states[i]`` reaches ``last[i]`` by the digits of ``words[i]``."""
    trie = Builder(n_states)
    at = np.asarray(states, dtype=np.int64)
    spelled = digits_of(words, digits)
    for d in range(digits):
        pairs, place = np.unique(at * ALPHABET + spelled[:, d], return_inverse=True)
        at = trie.add(pairs // ALPHABET, pairs % ALPHABET)[place]
    return *trie.arrays(), at
