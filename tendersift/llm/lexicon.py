"""A minimal acyclic transducer of words: shared prefixes and suffixes, one number per word, one flat file.

The file is mapped into memory by tasks. Numbers follow the sorted order of the words: every transition
carries how many words are passed over by taking it, so their sum along a word is its number.
"""

from __future__ import annotations

import numpy as np

HEAD = 4   # numbers before the tables: states, codes, longest word, words


def build(words: list[bytes]) -> bytes:
    """The automaton of distinct words that are not empty; state 0 is dead, state 1 is the root."""
    words = sorted(set(words))
    used = sorted({b for w in words for b in w})
    code = {b: i + 1 for i, b in enumerate(used)}
    arcs: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    below: list[int] = []
    known: dict[tuple, int] = {}

    def state(lo: int, hi: int, depth: int) -> int:
        """State accepting the rests of words[lo:hi] after `depth` bytes; equal sets of rests share one."""
        final = len(words[lo]) == depth
        i, out = lo + final, []
        while i < hi:
            b, j = words[i][depth], i
            while j < hi and words[j][depth] == b:
                j += 1
            out.append((code[b], state(i, j, depth + 1)))
            i = j
        key = (final, tuple(out))
        if key not in known:
            known[key] = len(arcs)
            arcs.append(key)
            below.append(final + sum(below[t] for _, t in out))
        return known[key]
    root = state(0, len(words), 0) if words else None
    states, codes = len(arcs) + 1, len(used) + 1
    place = {}   # root first, so that it is state 1
    if root is not None:
        place[root] = 1
        for s in range(len(arcs)):
            if s != root:
                place[s] = len(place) + 1
    table = np.zeros((max(states, 2), codes, 2), np.int32)
    finals = np.zeros(max(states, 2), np.int32)
    for s, (final, out) in enumerate(arcs):
        finals[place[s]] = final
        passed = int(final)
        for c, t in out:
            table[place[s], c] = place[t], passed
            passed += below[t]
    remap = np.zeros(256, np.int32)
    for b, c in code.items():
        remap[b] = c
    head = np.array([len(table), codes, max(map(len, words), default=0), len(words)], np.int32)
    return np.concatenate((head, remap, finals, table.ravel())).tobytes()


class Lexicon:
    def __init__(self, path: str):
        flat = np.memmap(path, np.int32, "r")
        states, codes, self.longest, self.size = (int(x) for x in flat[:HEAD])
        self.codes = codes
        self.remap = np.asarray(flat[HEAD:HEAD + 256])
        self.finals = flat[HEAD + 256:HEAD + 256 + states]
        self.table = flat[HEAD + 256 + states:].reshape(-1, 2)

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of the word at each byte range, -1 if it is not in the lexicon; all ranges advance together."""
        out = np.full(len(start), -1, np.int64)
        length = end - start
        at = np.flatnonzero((length > 0) & (length <= self.longest))
        state, number = np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
        for j in range(self.longest):
            if not len(at):
                break
            arc = state * self.codes + self.remap[data[start[at] + j]]
            step = self.table[arc]
            state, number = step[:, 0].astype(np.int64), number + step[:, 1]
            ended = length[at] == j + 1
            hit = ended & (self.finals[state] == 1) & (state > 0)
            out[at[hit]] = number[hit]
            go = ~ended & (state > 0)
            at, state, number = at[go], state[go], number[go]
        return out
