"""A minimal acyclic transducer from words to token ids, as flat arrays that tasks map into memory.

States that accept the same endings are one state, so suffixes are shared. Each edge carries the number of words that
sort before those below it; the sum along a word's path is the word's place in sorted order, and there its ids lie.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable

import numpy as np

#: Arrays of the image, in order, with their types.
PARTS = (("keys", np.int64), ("skips", np.int32), ("targets", np.int32), ("final", np.uint8),
         ("starts", np.int32), ("ids", np.int32))


class _State:
    __slots__ = ("final", "edges", "number", "below")

    def __init__(self):
        self.final, self.edges, self.number, self.below = False, {}, -1, -1


def _automaton(words: Iterable[bytes]) -> _State:
    """The minimal automaton of sorted different words, built one word at a time."""
    root, known, path, before = _State(), {}, [], b""

    def settle(keep: int) -> None:
        while len(path) > keep:
            parent, label, child = path.pop()
            mark = (child.final, tuple((k, id(c)) for k, c in child.edges.items()))
            parent.edges[label] = known.setdefault(mark, child)

    for word in words:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        settle(common)
        at = path[-1][2] if path else root
        for label in word[common:]:
            child = at.edges[label] = _State()
            path.append((at, label, child))
            at = child
        at.final, before = True, word
    settle(0)
    return root


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The image of a lexicon: word bytes to ids."""
    words = sorted(entries)
    root = _automaton(words)
    order, todo = [], [root]
    root.number = 0
    while todo:
        state = todo.pop()
        order.append(state)
        for child in state.edges.values():
            if child.number < 0:
                child.number = 0
                todo.append(child)
    for number, state in enumerate(order):
        state.number = number
    stack = [root]
    while stack:  # words below each state, children first
        state = stack[-1]
        open_ = [c for c in state.edges.values() if c.below < 0]
        if open_:
            stack.extend(open_)
            continue
        stack.pop()
        state.below = state.final + sum(c.below for c in state.edges.values())
    edges = []
    for state in order:
        skip = int(state.final)
        for label in sorted(state.edges):
            child = state.edges[label]
            edges.append((state.number << 8 | label, skip, child.number))
            skip += child.below
    edges.sort()
    keys, skips, targets = (np.array([e[k] for e in edges]) for k in range(3))
    starts = np.concatenate(([0], np.cumsum([len(entries[w]) for w in words], dtype=np.int64)))
    arrays = dict(keys=keys, skips=skips, targets=targets, final=np.array([s.final for s in order]), starts=starts,
                  ids=np.array([i for w in words for i in entries[w]]))
    body = [np.asarray(arrays[name], kind).tobytes() for name, kind in PARTS]
    sizes = np.array([len(arrays[name]) for name, _ in PARTS], np.int64).tobytes()
    return sizes + b"".join(part + bytes(-len(part) % 8) for part in body)


class Lexicon:
    """A compiled lexicon, read through a memory map of an unnamed temporary file."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(image)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self._map, np.int64, len(PARTS))
        at = sizes.nbytes
        for (name, kind), size in zip(PARTS, sizes.tolist()):
            part = np.frombuffer(self._map, kind, size, at)
            setattr(self, name, part)
            at += part.nbytes + -part.nbytes % 8

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the lexicon, −1 for others. All words walk the automaton together, byte by byte."""
        found = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return found
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words), np.uint8)
        walking = np.flatnonzero(size > 0)
        state, place = np.zeros(len(walking), np.int64), np.zeros(len(walking), np.int64)
        depth = 0
        while len(walking):
            key = state << 8 | data[first[walking] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[edge] == key
            walking, edge = walking[on], edge[on]
            state, place = self.targets[edge].astype(np.int64), place[on] + self.skips[edge]
            depth += 1
            ended = size[walking] == depth
            accepted = ended & (self.final[state] == 1)
            found[walking[accepted]] = place[accepted]
            walking, state, place = walking[~ended], state[~ended], place[~ended]
        return found

    def ids_at(self, places: np.ndarray) -> list[tuple[int, ...]]:
        """The ids of the words at ``places``."""
        low, size = self.starts[places], self.starts[places + 1] - self.starts[places]
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(low - (ends - size), size) + np.arange(size.sum())].tolist()
        return [tuple(flat[a:b]) for a, b in zip((ends - size).tolist(), ends.tolist())]
