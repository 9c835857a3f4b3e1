"""Encoding with a public piece model as a weighted transducer, and decoding.

Three machines are compiled from the model file. The normaliser rewrites spaces
to the model's space mark and puts one in front. The lexicon reads characters
and emits pieces: its states are the prefixes of pieces, its arcs characters,
its weights the pieces' negated scores; a character that no piece starts with
is emitted as its UTF-8 bytes (byte fallback). The third machine reads pieces
and says which may follow which: weight 0 where merging the two pieces' text
gives them back, infinite otherwise. A piece sequence that passes it pair by
pair is the model's own segmentation, so the shortest path of the input through
the composition (tropical semiring: weights add up, the least wins) gives the
library's ids.

Two neighbouring characters that stand together in no piece are never joined,
so texts fall into independent parts there. Every distinct word is composed once
per worker, and a batch's new words together: the paths of all of them advance
position by position in arrays.

Defined results: a null text is empty and has no ids; the space mark itself
reads as a space; decoding returns the text with such marks as spaces; repeated
rows and null ids are encoded each by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import inf
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Recent, frugal, joined, list_codes, small_batches

MARK = "▁"
_MODELS: dict[str, "Transducer"] = {}


class Transducer:
    """Normaliser, lexicon and pair machine of one model file."""

    # Longer words are cut into parts and composed one by one.
    SHORT = 64
    BLOCK = 20_000
    PADDING = 0x1FFFFF

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_ids, self.pieces, self.output = {}, {}, []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_ids[int(piece[3:5], 16)] = i
                self.output.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.output.append(b"")
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.output.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) or "\n" in p or "\t" in p for p in self.pieces):
            raise ValueError("a piece spans a cut between parts")
        # A state: its arcs by character, and the cost and id of the piece it emits (id -1: none).
        self.start: dict[str, list] = {}
        for piece, (i, score) in self.pieces.items():
            arcs = self.start
            for char in piece:
                state = arcs.setdefault(char, [{}, inf, -1])
                arcs = state[0]
            state[1:] = -score, i
        self._arrays()
        self.output = pa.array(self.output, pa.binary())
        self.names = {i: p for p, (i, _) in self.pieces.items()}
        self.together = {p[n : n + 2] for p in self.pieces for n in range(len(p) - 1)}
        # Marks that no piece joins to a letter in front: words end there.
        after = {p[1] for p in self.together if p[0].isalpha()}
        marks = "".join(re.escape(p) for p in sorted(self.pieces) if len(p) == 1 and not p.isalnum() and p not in after | {MARK})
        self.word_starts = rf"(\pL)([{marks}])" if marks else None
        self.splits: dict[str, list[str]] = {}
        self.follows: dict[int, bool] = {}
        self.words = Recent(150_000)

    def _arrays(self) -> None:
        """The lexicon as arrays: arcs sorted by state and character, and what each state emits."""
        keys, targets, weights, ids = [], [], [inf], [-1]
        waiting = [(0, self.start)]
        for state, arcs in waiting:
            for char, (further, weight, piece) in arcs.items():
                keys.append(state << 21 | ord(char))
                targets.append(len(ids))
                waiting.append((len(ids), further))
                weights.append(weight)
                ids.append(piece)
        order = np.argsort(keys)
        self.arc_keys, self.arc_to = np.array(keys, np.int64)[order], np.array(targets, np.int64)[order]
        self.weights, self.emits = np.array(weights), np.array(ids, np.int64)
        self.chars = np.array(sorted(ord(p) for p in self.pieces if len(p) == 1), np.int64)

    @classmethod
    def at(cls, path: str) -> "Transducer":
        if path not in _MODELS:
            _MODELS[path] = cls(path)
        return _MODELS[path]

    def words_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The normalised texts as words: bounds of each text, every word's place among the distinct ones, and these.

        Cuts stand in front of space marks, around line ends and tabs, and
        between a letter and a mark that never join.
        """
        texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
        cut = next(c for c in map(chr, range(0xE000, 0x110000)) if not pc.any(pc.match_substring(texts, c)).as_py())
        marked = pc.replace_substring(texts, " ", MARK)
        marked = pc.if_else(pc.equal(marked, ""), "", pc.binary_join_element_wise(MARK, marked, ""))
        marked = pc.replace_substring_regex(marked, f"({MARK}+)", rf"{cut}\1")
        marked = pc.replace_substring_regex(marked, "([\n\t])", rf"{cut}\1{cut}")
        if self.word_starts:
            marked = pc.replace_substring_regex(marked, self.word_starts, rf"\1{cut}\2")
        return list_codes(pc.split_pattern(marked, cut))

    def merged(self, text: str, least: int = 1) -> list[str]:
        """The model's merges on a short text down to ``least`` parts: the best scored pair first, then the leftmost."""
        parts = list(text)
        while len(parts) > least:
            scored = [(-self.pieces[a + b][1], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.pieces]
            if not scored:
                break
            k = min(scored)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def halves(self, piece: str) -> list[str]:
        """The two parts that the piece's last merge joins; more where merges never build it."""
        known = self.splits.get(piece)
        if known is None:
            known = self.splits[piece] = self.merged(piece, 2)
        return known

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging leaves the two pieces apart.

        The later of the two last merges is taken back, again and again: the
        neighbours across the cut must never have had a merge that came first.
        """
        a, b = self.names[first], self.names[second]
        pieces, limit, right = self.pieces, inf, False
        if (len(a) > 1 and len(self.halves(a)) != 2) or (len(b) > 1 and len(self.halves(b)) != 2):
            return False
        while True:
            both = pieces.get(a + b)
            if both and (-both[1] < limit or (right and -both[1] == limit)):
                return False
            rank_a = -pieces[a][1] if len(a) > 1 else -inf
            rank_b = -pieces[b][1] if len(b) > 1 else -inf
            if rank_a == rank_b == -inf:
                return True
            right = rank_b >= rank_a
            if right:
                limit, b = rank_b, self.halves(b)[0]
            else:
                limit, a = rank_a, self.halves(a)[1]

    def _allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """For pairs of pieces, ``may_follow``; a part's first piece has -1 before it."""
        if len(self.follows) > 500_000:
            self.follows.clear()
        keys = (before << 32 | piece).tolist()
        known = list(map(self.follows.get, keys))
        for k, value in enumerate(known):
            if value is None:
                key = keys[k]
                value = self.follows.get(key)
                if value is None:
                    value = self.follows[key] = key < 0 or self.may_follow(key >> 32, key & 0xFFFFFFFF)
                known[k] = value
        return np.array(known, bool)

    def shortest_of(self, parts: list[str]) -> list[bytes]:
        """Ids of the shortest paths of many short parts (none empty), one position of all parts at a time.

        Every character must be a piece of its own. Positions and piece ends are
        tried in the order of ``shortest``, so the paths are the same.
        """
        count, width = len(parts), max(map(len, parts))
        sizes = np.fromiter(map(len, parts), np.int64, count)
        flat = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        chars = np.full((width, count), self.PADDING, np.int64)
        chars[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(np.arange(count), sizes)] = flat
        cost = np.full((width + 1, count), inf)
        cost[0] = 0.0
        last, back = np.full((width + 1, count), -1, np.int64), np.zeros((width + 1, count), np.int64)
        for j in range(width):
            rows = np.flatnonzero((sizes > j) & (cost[j] < inf))
            here, before, state = cost[j, rows], last[j, rows], np.zeros(len(rows), np.int64)
            for i in range(j, width):
                key = state << 21 | chars[i, rows]
                at = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
                go = self.arc_keys[at] == key
                rows, here, before, state = rows[go], here[go], before[go], self.arc_to[at[go]]
                if not len(rows):
                    break
                reached = here + self.weights[state]
                better = np.flatnonzero(reached < cost[i + 1, rows])
                if len(better):
                    piece = self.emits[state[better]]
                    may = self._allowed(before[better], piece)
                    better, piece = better[may], piece[may]
                    to = rows[better]
                    cost[i + 1, to], last[i + 1, to], back[i + 1, to] = reached[better], piece, j
        rows, at, found = np.arange(count), sizes, []
        while len(rows):
            found.append((rows, at, last[at, rows]))
            at = back[at, rows]
            rows, at = rows[at > 0], at[at > 0]
        rows, at, ids = (np.concatenate(x) for x in zip(*found))
        raw = ids[np.lexsort((at, rows))].astype("<u4").tobytes()
        cuts = [0, *(np.cumsum(np.bincount(rows, minlength=count)) * 4).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def shortest(self, part: str) -> list[int]:
        """Ids of the shortest path that reads ``part``."""
        n = len(part)
        cost, last, back = [inf] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        cost[0] = 0.0
        start = self.start
        for j in range(n):
            here = cost[j]
            if here == inf:
                continue
            before, arcs = last[j], start
            for i in range(j + 1, n + 1):
                state = arcs.get(part[i - 1])
                if state is None:
                    break
                arcs, weight, piece = state
                if here + weight < cost[i]:
                    if before < 0 or self.may_follow(before, piece):
                        cost[i], last[i], back[i] = here + weight, piece, j
            if here < cost[j + 1] and part[j] not in self.pieces:  # byte fallback: nothing merges with it
                cost[j + 1], last[j + 1], back[j + 1] = here, -1, j
        ids: list[int] = []
        while n:
            j = back[n]
            if last[n] >= 0:
                ids.append(last[n])
            else:
                ids += [self.bytes_ids[b] for b in reversed(part[j:n].encode())]
            n = j
        return ids[::-1]

    def _cut(self, word: str) -> Iterator[str]:
        """A word's independent parts."""
        start = 0
        for at, pair in enumerate(map(add, word, word[1:]), 1):
            if pair not in self.together:
                yield word[start:at]
                start = at
        yield word[start:]

    def _of_words(self, new: list[str]) -> list[bytes]:
        """Ids of words: short ones of known characters together, others part by part."""
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        flat = np.frombuffer("".join(new).encode("utf-32-le"), "<u4")
        strange = ~np.isin(flat, self.chars)
        plain = (sizes > 0) & (sizes <= self.SHORT) & (np.bincount(np.repeat(np.arange(len(new)), sizes), strange, len(new)) == 0)
        out: list[bytes] = [b""] * len(new)
        # Words of like length meet in a block.
        picked = np.flatnonzero(plain)
        picked = picked[np.argsort(sizes[picked], kind="stable")].tolist()
        for at in range(0, len(picked), self.BLOCK):
            block = picked[at : at + self.BLOCK]
            for k, ids in zip(block, self.shortest_of([new[k] for k in block])):
                out[k] = ids
        for k in np.flatnonzero(~plain).tolist():
            out[k] = np.array([i for part in self._cut(new[k]) for i in self.shortest(part)], "<u4").tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, and the bounds of each text among them."""
        bounds, codes, distinct = self.words_of(texts)
        return joined(self.words.look_up(distinct, self._of_words), codes, bounds, 4)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of a batch of ids: the pieces' bytes joined, without the space in front."""
        pieces = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), self.output.take(pa.array(ids)))
        raw = pc.binary_join(pieces, b"")
        try:
            texts = raw.cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has
            texts = pa.array([x.decode(errors="replace") for x in raw.to_pylist()], pa.string())
        return pc.replace_substring_regex(texts, r"\A ", "")


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, ids): ids as little-endian unsigned 32-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.at(model)
        for batch in small_batches(batches, "text", 1 << 22):
            flat, bounds = machine.encode(batch.column("text"))
            raw, cuts = flat.tobytes(), (bounds * 4).tolist()
            ids = pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(bounds)), ids], names=["doc_id", "n_pieces", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(frugal(work), "doc_id bigint, n_pieces bigint, ids binary")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, ids, text): the texts that ids stand for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.at(model)
        for batch in small_batches(batches, "ids", 1 << 22):
            columns = [batch.column(c) for c in ("doc_id", "n_pieces", "ids")]
            flat = np.frombuffer(b"".join(columns[2].to_pylist()), "<u4")
            texts = machine.decode(flat, np.concatenate(([0], np.cumsum(columns[1].to_numpy()))))
            yield pa.record_batch([*columns, texts], names=["doc_id", "n_pieces", "ids", "text"])

    return ids.mapInArrow(frugal(work), "doc_id bigint, n_pieces bigint, ids binary, text string")
