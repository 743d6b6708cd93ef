"""Runs of repeated words, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period q, at least ``SHORTEST`` and at least 2q words long, that
no neighbouring word extends. The suffix links of an automaton form a tree; the words read so far are the path from the
state of the current prefix to its root. Reading word i accesses that path in a link-cut tree, which joins it to one
preferred path and colours it with i. The pieces it meets were coloured by earlier words: a piece of colour j whose
deepest state has length m says that the last m words also end at j, for no longer m and no later j. If the distance
d = i - j is at most m, the last m + d words have smallest period d and contain a square; m is as long as it can be, so
they can't be extended to the left, and they are a run if the next word doesn't go on. Every run is met exactly once, at
its last word. Accesses meet O(log n) pieces on average, whatever the text.

A run of at least 12 words repeats its words in blocks of at least 6, so all its words lie in 6-grams that occur twice.
Text is first cut to the stretches that such 6-grams cover, again and again inside each stretch; hashes that collide
only make a stretch longer. Nothing but these stretches needs the automaton, and no run crosses their ends.

Each document is worked alone in one task, nothing is shuffled. Memory grows with the longest stretch that repeats
itself, by about 0.7 KB a word, and by about 100 bytes for every other word of the text in hand.

Defined results: null and empty texts have no words and no runs, their collapsed text is empty; the words of a text are
what is between white space, so a text without runs collapses to its words joined by one space; repeated rows give
repeated results; rows without doc_id are like others; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: words of the shortest run.
SHORTEST = 12
#: A run repeats blocks of so many words.
GRAM = SHORTEST // 2
#: Cuts of a stretch into smaller ones; what is left then is searched as it is.
PASSES = 12
#: A result batch is sent at so many bytes of text.
SENT_BYTES = 4 << 20

Run = tuple[int, int, int]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _covered(codes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches [a, b) whose words lie in GRAM-grams that occur twice in codes."""
    n = len(codes) - GRAM + 1
    if n < 2:
        return []
    mixed = codes[:n].astype(np.uint64)
    for k in range(1, GRAM):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + codes[k : k + n].astype(np.uint64)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return []
    change = np.zeros(len(codes) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    change[at] += 1
    change[at + GRAM] -= 1  # the places are distinct, so no addition is lost
    inside = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= SHORTEST]


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint stretches that hold all runs."""
    out, todo = [], [(0, len(codes), 0)]
    while todo:
        a, b, turn = todo.pop()
        found = _covered(codes[a:b])
        for x, y in found:
            if y - x == b - a or turn == PASSES:
                out.append((a + x, a + y))
            else:
                todo.append((a + x, a + y, turn + 1))
    return sorted(out)


def suffix_links(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of each state of the automaton (1 is the root, 0 none), and the state of each prefix."""
    size, link, steps = [0, 0], [0, 0], [{}, {}]
    prefixes, last = [], 1
    for i, word in enumerate(words, 1):
        state = len(size)
        size.append(i)
        steps.append({})
        p = last
        while p and word not in steps[p]:
            steps[p][word] = state
            p = link[p]
        if not p:
            link.append(1)
        else:
            q = steps[p][word]
            if size[q] == size[p] + 1:
                link.append(q)
            else:
                copy = state + 1
                link.append(copy)
                size.append(size[p] + 1)
                steps.append(steps[q].copy())
                link.append(link[q])
                link[q] = copy
                while p and steps[p].get(word) == q:
                    steps[p][word] = copy
                    p = link[p]
        prefixes.append(state)
        last = state
    return size, link, prefixes


class PathColours:
    """Link-cut tree over parent links: ``access`` makes the path to the root one piece of a new colour.

    Each piece is a splay tree ordered by depth, its colour is kept at the splay root only.
    """

    def __init__(self, parent: list[int]):
        self.up = list(parent)  # in the splay tree, or from its root to the piece above
        self.left = [0] * len(parent)
        self.right = [0] * len(parent)
        self.colour = [-1] * len(parent)

    def _rotate(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> int:
        """Makes x the root of its splay tree; its colour."""
        up, left, right, colour = self.up, self.left, self.right, self.colour
        found = colour[x]
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                found = colour[g]
                self._rotate(*((p, g) if (left[g] == p) == (left[p] == x) else (x, p)))
                self._rotate(x, up[x])
            else:
                found = colour[p]
                self._rotate(x, p)
        colour[x] = found
        return found

    def access(self, x: int, new: int) -> list[tuple[int, int]]:
        """Colours the path from x to the root; the pieces it met, as (deepest node on the path, colour)."""
        up, right, colour = self.up, self.right, self.colour
        met, below = [], 0
        while x:
            old = self._splay(x)
            if old >= 0:
                met.append((x, old))
            if right[x]:
                colour[right[x]] = old
            right[x] = below
            below, x = x, up[x]
        colour[below] = new
        return met


def _runs_of(words: list[int]) -> Iterator[Run]:
    size, link, prefixes = suffix_links(words)
    tree, n = PathColours(link), len(words)
    for i, state in enumerate(prefixes):
        for node, before in tree.access(state, i):
            d, length = i - before, size[node]
            if d <= length and length + d >= SHORTEST and (i + 1 == n or words[i + 1] != words[i + 1 - d]):
                yield i + 1 - d - length, length + d, d


def find_runs(words: list) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out = [(a + s, length, q) for a, b in stretches(codes) for s, length, q in _runs_of(codes[a:b].tolist())]
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_repeats(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def analyse(docs: DataFrame, change: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), collapsed (text without repeats) of every row.

    ``change`` may turn the words of a document into others before they are searched.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, sizes, runs, texts = zip(*rows)
        flat = np.array([r for some in runs for r in some], np.int64).reshape(-1, 3)
        items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), items)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists, pa.array(texts, pa.string())], schema=_OUT)

    def run(batches):
        for found in batches:
            out, held = [], 0
            for doc_id, text in zip(found.column(0), found.column(1)):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                if change is not None:
                    words = change(words, doc_id.as_py())
                runs = find_runs(words)
                collapsed = b" ".join(without_repeats(words, runs))
                out.append((doc_id.as_py(), len(words), runs, collapsed))
                held += len(collapsed) + 24 * len(runs) + 100
                if held > SENT_BYTES:
                    yield batch(out)
                    out, held = [], 0
            if out:
                yield batch(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, kind)
