"""Minimal acyclic transducers from sorted terms to their lexicographic ordinals.

Terms come in ascending byte order.  A state is closed once no later term can pass through it,
and closed states that accept the same endings are one state, so the automaton is minimal while
it is built.  A transition's output is the number of terms that leave its state before it (the
empty ending first), so the outputs along a term add up to the term's place among all terms.
The closed automaton is four arrays; texts walk it with all their words side by side.
"""

from __future__ import annotations

import io

import numpy as np


class Transducer:
    """``keys`` (state * 256 + byte, ascending), ``targets``, ``outputs``, ``final`` by state."""

    def __init__(self, keys, targets, outputs, final, root: int, longest: int, low: int, high: int):
        self.keys, self.targets, self.outputs, self.final = keys, targets, outputs, final
        self.root, self.longest, self.low, self.high = root, longest, low, high

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, keys=self.keys, targets=self.targets, outputs=self.outputs, final=self.final,
                 shape=np.array([self.root, self.longest], np.int64), ends=np.array([self.low, self.high], np.uint64))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        a = np.load(io.BytesIO(raw))
        return cls(a["keys"], a["targets"], a["outputs"], a["final"], int(a["shape"][0]), int(a["shape"][1]),
                   int(a["ends"][0]), int(a["ends"][1]))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinal of each word ``data[start:start + length]``, -1 for words it does not hold."""
        found = np.full(len(starts), -1, np.int64)
        live = np.flatnonzero(lengths <= self.longest)
        state = np.full(len(live), self.root, np.int64)
        total = np.zeros(len(live), np.int64)
        for i in range(self.longest):
            if not len(live):
                break
            key = state * 256 + data[starts[live] + i]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state, total = self.targets[at].astype(np.int64), total[hit] + self.outputs[at]
            ended = lengths[live] == i + 1
            whole = ended & self.final[state]
            found[live[whole]] = total[whole]
            live, state, total = live[~ended], state[~ended], total[~ended]
        return found


def head(term: bytes) -> int:
    """The first eight bytes as a number; sorted terms have ascending heads."""
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def heads(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``head`` of every word."""
    out = np.zeros(len(starts), np.uint64)
    last = len(data) - 1
    for i in range(8):
        byte = np.where(lengths > i, data[np.minimum(starts + i, last)], 0).astype(np.uint64)
        out = (out << np.uint64(8)) | byte
    return out


def build(terms: list[bytes]) -> Transducer:
    """The transducer of non-empty ``terms`` in strictly ascending byte order."""
    known: dict[tuple, int] = {}
    final: list[bool] = []
    below: list[int] = []  # terms that a closed state accepts
    open_states: list[list] = [[False, []]]  # along the last term: accepts here?, closed transitions

    def close(state: list) -> int:
        shape = (state[0], tuple(state[1]))
        number = known.get(shape)
        if number is None:
            number = known[shape] = len(final)
            final.append(state[0])
            below.append(int(state[0]) + sum(below[t] for _, t in state[1]))
        return number

    last = b""
    for term in terms:
        if term <= last:
            raise ValueError("terms must ascend strictly")
        shared = 0
        for x, y in zip(term, last):
            if x != y:
                break
            shared += 1
        while len(open_states) > shared + 1:
            done = close(open_states.pop())
            open_states[-1][1].append((last[len(open_states) - 1], done))
        open_states.extend([False, []] for _ in range(len(term) - shared))
        open_states[-1][0] = True
        last = term
    while len(open_states) > 1:
        done = close(open_states.pop())
        open_states[-1][1].append((last[len(open_states) - 1], done))
    root = close(open_states[0])

    keys, targets, outputs = [], [], []
    for (accepts, moves), number in known.items():
        before = int(accepts)
        for byte, target in moves:
            keys.append(number * 256 + byte)
            targets.append(target)
            outputs.append(before)
            before += below[target]
    order = np.argsort(np.array(keys, np.int64))
    return Transducer(np.array(keys, np.int64)[order], np.array(targets, np.int32)[order],
                      np.array(outputs, np.int32)[order], np.array(final, bool), root,
                      max(map(len, terms)), head(terms[0]), head(terms[-1]))
