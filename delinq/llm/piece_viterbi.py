"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation under the piece scores of a model file is found from left to right. Scores are kept for
the positions a piece can still reach (the longest piece bounds them); back pointers are kept from the last
committed boundary on. Whenever that window is full and the paths to all reachable positions run through one boundary, the
ids before it are committed. Of equal scores the path through the longer last piece stays.

No piece of a vocabulary may join a blank to a character before it (checked when it is loaded), so every path
runs through the boundary before a blank, and the search starts afresh there. What stands between two such
boundaries is remembered per worker, about ``KNOWN`` entries in two generations that are bounded by length.

Segments no longer than the longest piece fit into the window as a whole. New ones of them are searched side by side, all
at one position, over a table of the vocabulary's tree for its ``COMMON`` commonest characters; longer segments, and
those with other characters, are searched one by one.

As in the model files: one blank is put before a text, characters without a piece become byte pieces at a score
below all others. A literal U+2581 becomes bytes too, so decoding gives back every text exactly.

Defined results: null and empty texts have no ids and decode to an empty text; repeated rows and equal doc_ids
are encoded one by one; an empty table gives an empty table; other columns are not read. A text of any length is
encoded whole; a task holds its ids and one window of scores.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from delinq.llm.common import Memory, by_bytes

#: Fixed values of the model files: the sign for a blank, what the score of an unknown character is less by.
BLANK_SIGN = "\u2581"
UNKNOWN_PENALTY = 10.0
#: Remembered segments per Python worker; rows encoded at once.
KNOWN = 250_000
ROWS = 256
#: Characters with a column in the table of the tree; segments searched side by side.
COMMON = 127
SIDE_BY_SIDE = 20_000
_NEVER = float("-inf")

_SEGMENT = re.compile(r" *[^ ]+| +")


def _steps(tree: dict) -> dict:
    """The tree as the search reads it: character to (tree behind it, id or -1, score)."""
    return {c: (_steps(node), *node.get("", (-1, 0.0))) for c, node in tree.items() if c}


class Pieces:
    """Vocabulary of a model file: a tree of characters with ids and scores, and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        tree: dict = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.longest, lowest = 1, 0.0
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
                continue
            text = piece.replace(BLANK_SIGN, " ")
            if " " in text.lstrip(" "):
                raise ValueError(f"piece {i} joins a blank to a character before it")
            self.bytes_of.append(text.encode())
            node, score = tree, model.get_score(i)
            for c in text:
                node = node.setdefault(c, {})
            node[""] = (i, score)
            self.longest, lowest = max(self.longest, len(text)), min(lowest, score)
        self.unknown = lowest - UNKNOWN_PENALTY
        self.steps = _steps(tree)
        self._tabulate(tree)
        self.single = {c for c, (_, piece, _) in self.steps.items() if piece >= 0}
        self.known = Memory(KNOWN)

    @cached_property
    def tree(self) -> dict:
        """The vocabulary as nested dictionaries, "" to (id, score) where a piece ends."""

        def back(steps: dict) -> dict:
            return {c: back(node) | ({"": (i, score)} if i >= 0 else {}) for c, (node, i, score) in steps.items()}

        return back(self.steps)

    def _tabulate(self, tree: dict) -> None:
        """``table``: node (0: none, 1: the root) and character code (0: none) to node; ``piece`` and ``gain`` by node."""
        nodes, seen = [tree], {}
        for node in nodes:
            for c, below in node.items():
                if c:
                    seen[c] = seen.get(c, 0) + 1
                    nodes.append(below)
        common = sorted(seen, key=lambda c: (-seen[c], c))[:COMMON]
        code = {c: k for k, c in enumerate(common, 1)}
        self.code_of = np.zeros(0x110000, np.uint8)
        self.code_of[[ord(c) for c in common]] = range(1, len(common) + 1)
        self.table = np.zeros((len(nodes) + 1, COMMON + 1), np.int32)
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.gain = np.zeros(len(nodes) + 1)
        number = {id(node): k for k, node in enumerate(nodes, 1)}
        for k, node in enumerate(nodes, 1):
            for c, below in node.items():
                if not c:
                    self.piece[k], self.gain[k] = below
                elif c in code:
                    self.table[k, code[c]] = number[id(below)]

    def ids_of(self, start_id: int, text: str) -> list[int]:
        """A found piece, or the byte pieces of a character without one."""
        return [start_id] if start_id >= 0 else [self.byte_ids[b] for b in text.encode()]

    def search(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, yielded as they are committed."""
        tree, longest, single, unknown, n = self.steps, self.longest, self.single, self.unknown, len(text)
        base, room = 0, min(n, 2 * longest) + 1  # the last commit; positions held from there on
        scores, starts, found_ids = [0.0] + [_NEVER] * (room - 1), [0] * room, [-1] * room
        for at in range(n):
            k = at - base
            score, node = scores[k], tree
            if k + longest >= room and base + room <= n:
                scores.append(_NEVER)
                starts.append(0)
                found_ids.append(-1)
                room += 1
            if text[at] not in single:
                if score + unknown > scores[k + 1]:
                    scores[k + 1], starts[k + 1], found_ids[k + 1] = score + unknown, at, -1
            for c in text[at : at + longest]:
                k += 1
                found = node.get(c)
                if found is None:
                    break
                node, piece, gain = found
                if piece >= 0 and score + gain > scores[k]:
                    scores[k], starts[k], found_ids[k] = score + gain, at, piece
            meet = at + 1
            if meet < n:
                if meet - base < longest:
                    continue  # the window isn't full
                live = {base + k for k in range(meet - base, room) if scores[k] > _NEVER}
                while len(live) > 1 and base not in live:
                    furthest = max(live)
                    live.remove(furthest)
                    live.add(starts[furthest - base])
                meet = min(live)
            if meet > base:
                ids, end = [], meet
                while end > base:
                    start, piece = starts[end - base], found_ids[end - base]
                    ids += [piece] if piece >= 0 else self.ids_of(-1, text[start:end])[::-1]
                    end = start
                yield ids[::-1]
                scores, starts, found_ids = (x[meet - base :] for x in (scores, starts, found_ids))
                base, room = meet, len(scores)
                more = min(n - base, 2 * longest) + 1 - room
                if more > 0:
                    scores += [_NEVER] * more
                    starts += [0] * more
                    found_ids += [-1] * more
                    room += more

    def _alone(self, segment: str) -> bytes:
        return array("i", [i for some in self.search(segment) for i in some]).tobytes()

    def search_many(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment, as ``search`` finds them."""
        sizes = np.array([len(s) for s in segments], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        codes = self.code_of[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        unusual = np.add.reduceat(np.append(codes == 0, False), starts[:-1]) > 0 if len(segments) else np.empty(0, bool)
        fits = (sizes > 0) & (sizes <= self.longest) & ~unusual
        rows = np.flatnonzero(fits)
        rows = rows[np.argsort(-sizes[rows], kind="stable")]
        out: list[bytes] = [b""] * len(segments)
        for at in range(0, len(rows), SIDE_BY_SIDE):
            some = rows[at : at + SIDE_BY_SIDE]
            for i, ids in zip(some.tolist(), self._side_by_side(codes, starts[some], sizes[some])):
                out[i] = ids
        for i, ids in enumerate(out):
            if not ids:  # unusual, or through a character without a piece
                out[i] = self._alone(segments[i])
        return out

    def _side_by_side(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Segments by falling size; empty where a path needs bytes."""
        n, width = len(sizes), int(sizes[0])
        places = starts[:, None] + np.arange(width)
        held = np.where(np.arange(width) < sizes[:, None], codes[np.minimum(places, len(codes) - 1)], 0)
        scores, back, ids = np.full((n, width + 1), _NEVER), np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        scores[:, 0] = 0.0
        single = self.piece[self.table[1]] >= 0
        for at in range(width):
            rows = np.arange(np.searchsorted(-sizes, -at, side="left"))  # longer than at
            score = scores[rows, at]
            bare = rows[~single[held[rows, at]] & (score + self.unknown > scores[rows, at + 1])]
            scores[bare, at + 1], back[bare, at + 1], ids[bare, at + 1] = scores[bare, at] + self.unknown, at, -1
            node = np.ones(len(rows), np.int32)
            for end in range(at + 1, width + 1):
                node = self.table[node, held[rows, end - 1]]
                alive = node > 0
                rows, node, score = rows[alive], node[alive], score[alive]
                if not len(rows):
                    break
                reached = score + self.gain[node]
                better = (self.piece[node] >= 0) & (reached > scores[rows, end])
                found = rows[better]
                scores[found, end], back[found, end], ids[found, end] = reached[better], at, self.piece[node[better]]
        path = np.full((n, width), -1, np.int32)
        bytes_needed = np.zeros(n, bool)
        every, end, step = np.arange(n), sizes.copy(), width
        while (more := end > 0).any():
            step -= 1
            rows = every[more]
            path[rows, step] = ids[rows, end[rows]]
            bytes_needed[rows[path[rows, step] < 0]] = True
            end[rows] = back[rows, end[rows]]
        # Paths end at different steps: the first ids of a segment stand where its walk stopped.
        taken = path >= 0
        counts = np.where(bytes_needed, 0, taken.sum(axis=1))
        data = path[taken & ~bytes_needed[:, None]].astype("<i4").tobytes()
        stops = np.cumsum(4 * counts).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = []  # segments without their first blank
        for text in texts:
            words = text.split(" ")
            plain = "" not in words
            cut.append(words if plain else [s[1:] for s in _SEGMENT.findall(" " + text)] if text else [])
        new = self.known.missing(set().union(*cut))
        known = self.known.now
        known.update(zip(new, self.search_many([" " + s for s in new])))
        return [b"".join([known[s] for s in segments]) for segments in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One vocabulary per path and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _mapped(docs: DataFrame, column: str, new: str, kind: DataType, convert) -> DataFrame:
    """``docs`` with a column made from another, a bounded number of rows at a time."""
    schema = StructType([*docs.schema.fields, StructField(new, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(column)
            slices = by_bytes(batch, place, ROWS) if pa.types.is_string(batch.schema.field(place).type) else (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS))
            for some in slices:
                made = convert(some.column(place))
                yield pa.RecordBatch.from_arrays([*some.columns, made], [*some.schema.names, new])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column as array<int>."""

    def convert(texts: pa.Array) -> pa.Array:
        found = pieces(model).encode_all([t or "" for t in texts.to_pylist()])
        offsets = np.cumsum([0, *[len(f) // 4 for f in found]], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))

    return _mapped(docs, text, ids, ArrayType(IntegerType()), convert)


def decode(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of an id column; null gives an empty text."""

    def convert(lists: pa.Array) -> pa.Array:
        return pa.array([pieces(model).decode(i or []) for i in lists.to_pylist()], pa.string())

    return _mapped(docs, ids, text, StringType(), convert)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars, n_ids, ids, round_trip (the decoded ids are the text) of every document."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = decode(encode(texts, model), model)
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
