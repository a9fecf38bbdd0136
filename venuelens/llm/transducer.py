"""Minimal acyclic transducers: sorted terms to their ordinals, walked by many words at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Transducer:
    """Arcs ascending by (state, byte). The outputs along the path of a term add up to its ordinal among all terms."""

    label: np.ndarray  # state * 256 + byte
    target: np.ndarray
    output: np.ndarray
    final: np.ndarray  # by state; the start state is the last one

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each byte range of `data`, -1 where it is no term."""
        out = np.zeros(len(starts), dtype=np.int64)
        state = np.full(len(starts), len(self.final) - 1, dtype=np.int64)
        going, step = np.flatnonzero(ends > starts), 0
        while len(going) and len(self.label):
            label = state[going] << 8 | data[starts[going] + step]
            arc = np.minimum(np.searchsorted(self.label, label), len(self.label) - 1)
            found = self.label[arc] == label
            state[going[~found]] = -1
            going, arc = going[found], arc[found]
            out[going] += self.output[arc]
            state[going] = self.target[arc]
            step += 1
            going = going[ends[going] - starts[going] > step]
        if not len(self.label):
            state[ends > starts] = -1
        return np.where((state >= 0) & self.final[state], out, -1)

    def to_bytes(self) -> dict[str, bytes]:
        return {"label": self.label.astype("<i8").tobytes(), "target": self.target.astype("<i4").tobytes(), "output": self.output.astype("<i4").tobytes(), "final": np.packbits(self.final).tobytes()}

    @classmethod
    def from_bytes(cls, label: bytes, target: bytes, output: bytes, final: bytes, states: int) -> Transducer:
        return cls(*(np.frombuffer(x, t) for x, t in ((label, "<i8"), (target, "<i4"), (output, "<i4"))), np.unpackbits(np.frombuffer(final, np.uint8), count=states).astype(bool))


def build(terms: Sequence[bytes]) -> Transducer:
    """The smallest transducer for distinct ascending terms.

    States are finished from the end of a term backwards, as soon as the next term leaves its path; a state that accepts the same
    endings as one before is that one. The output of an arc is the number of terms that its state accepts by way of lower arcs.
    """
    known: dict[tuple, int] = {}
    accepted: list[int] = []
    label, target, output, final = [], [], [], []
    path: list[list] = [[False, []]]  # of the last term: whether a term ends here, and the finished arcs (byte, state)
    last = b""

    def finish(depth: int) -> None:
        while len(path) > depth:
            ends, arcs = path.pop()
            key = (ends, tuple(arcs))
            state = known.get(key)
            if state is None:
                state = known[key] = len(accepted)
                before = int(ends)
                for byte, to in arcs:
                    label.append(state << 8 | byte)
                    target.append(to)
                    output.append(before)
                    before += accepted[to]
                accepted.append(before)
                final.append(ends)
            if path:
                path[-1][1].append((last[len(path) - 1], state))

    for term in terms:
        common = 0
        while common < len(last) and common < len(term) and last[common] == term[common]:
            common += 1
        finish(common + 1)
        path.extend([False, []] for _ in range(len(term) - common))
        path[-1][0] = True
        last = term
    finish(0)
    return Transducer(np.array(label, np.int64), np.array(target, np.int32), np.array(output, np.int32), np.array(final, bool))
