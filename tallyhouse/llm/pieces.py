"""SentencePiece encoding by streaming Viterbi, and decoding.

The best segmentation of a text under the pieces' scores, found left to right. The window that is kept is bounded by
the longest piece as long as paths converge: as soon as all surviving paths pass one boundary, the ids up to it are
final and leave the window. A boundary that no piece spans (before a word, in the usual vocabularies) is always
such a point; a text between two of them is a segment whose ids depend on nothing else. Segments no longer than the
longest piece are one window; a task solves many of them in lockstep and keeps the ids of those it has seen.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back

#: Folder of the vocabulary files; a parameter of every function that opens one.
TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
#: The sign that stands for a space.
SPACE = "▁"
#: Segments that a task remembers (some 200 bytes each), and how many are solved at once.
KNOWN_SEGMENTS = 200_000
_TOGETHER = 8192
#: Added to a byte's score for each byte of a character that no piece has, so that pieces are preferred.
UNKNOWN_PENALTY = 10.0

# wire format of the model file (protocol buffers): field numbers of the public schema, fixed values
_PIECES, _PIECE, _SCORE, _TYPE = 1, 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of a message: bytes for lengths, ints for the rest."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + size]
            at += size


#: A run of spaces with what follows it.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.DOTALL)
_LETTER = re.compile(r"[^\W\d_]")


def letter_cuts(others: str = "") -> re.Pattern:
    """The same, cut where letters meet other signs; ``others`` are signs that are no letters though ``\\w`` has them."""
    others = re.escape(others)
    return re.compile(f"{SPACE}*[^\\W\\d_{others}]+|{SPACE}*(?:[\\W\\d_{others}](?<!{SPACE}))+|{SPACE}+", re.DOTALL)


class Trie:
    """Beginnings of pieces as numbered states (0: nothing read), with an open hash table from (state, code) to state."""

    def __init__(self, ids: dict[str, int], scores: list[float]):
        states: dict[str, int] = {"": 0}
        for text in ids:
            for n in range(1, len(text) + 1):
                states.setdefault(text[:n], len(states))
        self.piece = np.full(len(states), -1, dtype=np.int64)
        self.score = np.full(len(states), -np.inf)
        for text, i in ids.items():
            self.piece[states[text]], self.score[states[text]] = i, scores[i]
        keys = np.array([(states[t[:-1]] << 21) | ord(t[-1]) for t in states if t], dtype=np.int64)
        values = np.array([i for t, i in states.items() if t], dtype=np.int64)
        self.mask = (1 << max(4, (4 * len(states)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.next = np.full(self.mask + 1, -1, dtype=np.int64)
        place = self._place(keys)
        while len(keys):  # those that find a free slot stay, the rest goes on
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]
            kept = self.keys[place] == keys
            self.next[place[kept]] = values[kept]
            keys, values, place = keys[~kept], values[~kept], (place[~kept] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(32)) & np.uint64(self.mask)).astype(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next state of each, -1 where no piece goes on like that."""
        key = (state << 21) | code
        place = self._place(key)
        found = self.keys[place]
        out = np.where(found == key, self.next[place], -1)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            found = self.keys[place[left]]
            hit = found == key[left]
            out[left[hit]] = self.next[place[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


@dataclass
class Vocabulary:
    """Pieces with scores and ids. ``bytes_at`` are the ids of the 256 byte pieces."""

    ids: dict[str, int]
    scores: list[float]
    texts: list[str]
    kinds: list[int]

    def __post_init__(self):
        self.bytes_at = {int(t[3:5], 16): i for i, t in enumerate(self.texts) if self.kinds[i] == _BYTE}
        self.longest = max((len(t) for t in self.ids), default=1)
        self.lowest = min(self.scores, default=0.0)
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == _UNKNOWN), 0)
        #: no piece has a space behind another character, so that no piece spans the boundary before a space
        self.splits_at_space = not any(SPACE in t.lstrip(SPACE) for t in self.ids)
        self.scored = {t: (self.scores[i], i) for t, i in self.ids.items()}
        self.trie = Trie(self.ids, self.scores)
        # words end at their last letter, too, unless that cuts a piece (² and ½ are of \w, but no letters: '².' is a piece)
        others = {c for t in self.ids for c in t if _LETTER.match(c) and not c.isalpha()}
        letters = letter_cuts("".join(sorted(others)))
        self.cuts = _WORDS if any(len(letters.findall(t)) > 1 for t in self.ids) else letters
        self.spelled = [self._spelled(i) for i in range(len(self.texts))]

    def _spelled(self, i: int) -> bytes:
        if self.kinds[i] == _BYTE:
            return bytes((int(self.texts[i][3:5], 16),))
        return b"" if self.kinds[i] == _CONTROL else self.texts[i].replace(SPACE, " ").encode("utf-8")

    def byte_value(self, i: int) -> int | None:
        return int(self.texts[i][3:5], 16) if self.kinds[i] == _BYTE else None


def load_vocabulary(path: str) -> Vocabulary:
    import struct

    with open(path, "rb") as file:
        data = file.read()
    ids, scores, texts, kinds = {}, [], [], []
    for field, value in _fields(data):
        if field == _PIECES:
            piece = {1: b"", 2: struct.pack("<f", 0), 3: _NORMAL} | dict(_fields(value))
            text = piece[_PIECE].decode("utf-8")
            if piece[_TYPE] in (_NORMAL, _USER):
                ids[text] = len(texts)
            scores.append(struct.unpack("<f", piece[_SCORE])[0])
            texts.append(text)
            kinds.append(piece[_TYPE])
    return Vocabulary(ids, scores, texts, kinds)


def normalise(text: str) -> str:
    """A space in front, and the sign for every space: what the vocabulary's identity rule does, none for no text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._known: dict[str, tuple[int, ...]] = {}
        #: the widest window of the last call of ``stream``
        self.widest = 0

    def _fallback(self, char: str) -> list[int]:
        at = self.vocabulary.bytes_at
        data = char.encode("utf-8", "surrogatepass")
        return [at[b] for b in data] if all(b in at for b in data) else [self.vocabulary.unknown]

    def stream(self, text: str):
        """Yield lists of final ids of a normalised text. Only the window behind the last converged boundary is kept.

        Every boundary keeps its best predecessor; a piece reaches back at most ``longest`` characters, so a boundary
        further back is alive only through paths that pass it. If the predecessors of all boundaries within reach lead
        to one boundary, every later path goes through it. Of equal scores the longer last piece wins.
        """
        vocabulary = self.vocabulary
        scored, longest = vocabulary.scored, vocabulary.longest
        floor = vocabulary.lowest - UNKNOWN_PENALTY
        base = 0  # the boundary that the window starts at
        best: list[float] = [0.0]
        back: list[int] = [0]  # predecessor, counted from base
        self.widest = 0
        for end in range(1, len(text) + 1):
            top, origin = float("-inf"), end - 1 - base
            for start in range(max(base, end - longest), end):
                found = scored.get(text[start:end])
                if found is not None:
                    value = best[start - base] + found[0]
                    if value > top:
                        top, origin = value, start - base
            if end - 1 >= base:
                single = best[end - 1 - base] + floor
                if top == float("-inf") or (text[end - 1] not in scored and single > top):
                    top, origin = single, end - 1 - base
            best.append(top)
            back.append(origin)
            self.widest = max(self.widest, len(best))
            if end - base >= longest:  # where do the paths that still can grow come from?
                alive = set(range(max(0, end - base - longest + 1), end - base + 1))
                while len(alive) > 1:
                    last = max(alive)
                    alive.discard(last)
                    alive.add(back[last])
                point = alive.pop()
                if point > 0:
                    yield self._ids(text, base, back, point)
                    score = best[point]
                    best = [b - score for b in best[point:]]
                    back = [0, *(max(0, b - point) for b in back[point + 1 :])]
                    base += point
        if len(best) > 1:
            yield self._ids(text, base, back, len(best) - 1)

    def _ids(self, text: str, base: int, back: list[int], point: int) -> list[int]:
        spans = []
        while point > 0:
            spans.append((back[point], point))
            point = back[point]
        out: list[int] = []
        for start, end in reversed(spans):
            piece = text[base + start : base + end]
            found = self.vocabulary.ids.get(piece)
            out.extend([found] if found is not None else self._fallback(piece))
        return out

    def segments(self, text: str) -> list[str]:
        """A text cut at boundaries that no piece spans: all paths pass there, so each segment stands alone."""
        if not text:
            return []
        if not self.vocabulary.splits_at_space:
            return [normalise(text)]
        return self.vocabulary.cuts.findall(normalise(text))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text. Segments that were not seen yet are solved together, long ones by ``stream``."""
        known = self._known
        cut = [self.segments(t) for t in texts]
        if len(known) > KNOWN_SEGMENTS:
            known.clear()
        new = {s for segments in cut for s in segments}.difference(known)
        longest = self.vocabulary.longest
        short = [s for s in new if len(s) <= longest]
        for at in range(0, len(short), _TOGETHER):
            part = short[at : at + _TOGETHER]
            known.update(zip(part, self._lockstep(part)))
        # long segments are many characters and rare: not remembered beyond these texts
        long = {s: [i for part in self.stream(s) for i in part] for s in new if len(s) > longest}
        if not long:
            return [list(chain.from_iterable(map(known.__getitem__, segments))) for segments in cut]
        return [list(chain.from_iterable(known[s] if s in known else long[s] for s in segments)) for segments in cut]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def _lockstep(self, segments: list[str]) -> list[tuple[int, ...]]:
        """Segments no longer than the longest piece, each one window: their paths are followed together.

        From every start the pieces are walked character by character in the trie of pieces, for all segments at once.
        """
        trie, floor = self.vocabulary.trie, self.vocabulary.lowest - UNKNOWN_PENALTY
        lengths = np.array([len(s) for s in segments])
        rows, width = len(segments), int(lengths.max())
        codes = np.full((rows, width), -1, dtype=np.int64)
        codes[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        best = np.full((rows, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((rows, width + 1), dtype=np.int64)
        ids = np.full((rows, width + 1), -1, dtype=np.int64)
        for start in range(width):
            row = np.flatnonzero(lengths > start)
            state = trie.step(np.zeros(len(row), np.int64), codes[row, start])
            so_far = best[row, start]
            alone = (state < 0) | (trie.piece[state] < 0)
            lone, value = row[alone], so_far[alone] + floor
            better = value > best[lone, start + 1]
            lone = lone[better]
            best[lone, start + 1], back[lone, start + 1], ids[lone, start + 1] = value[better], start, -1
            end = start + 1
            while True:
                alive = state >= 0
                row, state, so_far = row[alive], state[alive], so_far[alive]
                value = so_far + trie.score[state]
                better = value > best[row, end]
                to = row[better]
                best[to, end], back[to, end], ids[to, end] = value[better], start, trie.piece[state[better]]
                going = lengths[row] > end
                row, state, so_far = row[going], state[going], so_far[going]
                if not len(row):
                    break
                state = trie.step(state, codes[row, end])
                end += 1
        at, every = lengths.copy(), np.arange(rows)
        out = np.full((rows, width), -2, dtype=np.int64)
        for place in range(width - 1, -1, -1):
            open_rows = at > 0
            out[open_rows, place] = ids[every[open_rows], at[open_rows]]
            at = np.where(open_rows, back[every, at], 0)
        pieces = (out != -2).sum(axis=1)
        made = [tuple(row[width - n :]) for row, n in zip(out.tolist(), pieces.tolist())]
        for i in np.flatnonzero((out == -1).any(axis=1)).tolist():
            made[i] = tuple(self._with_bytes(segments[i], made[i]))
        return made

    def _with_bytes(self, text: str, ids: tuple[int, ...]) -> list[int]:
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(i)
                at += len(self.vocabulary.texts[i])
            else:
                out.extend(self._fallback(text[at]))
                at += 1
        return out

    def decode(self, ids) -> str:
        """The text of the ids: pieces joined, bytes as UTF-8 (U+FFFD for what is none), the space in front removed.

        An id that the vocabulary has not, also a negative or a null one, is U+FFFD.
        """
        spelled = self.vocabulary.spelled
        if not all(i is not None and 0 <= i < len(spelled) for i in ids):
            lost = "\ufffd".encode()
            data = b"".join(spelled[i] if i is not None and 0 <= i < len(spelled) else lost for i in ids)
        else:
            data = b"".join(map(spelled.__getitem__, ids))
        data = data.decode("utf-8", "replace")
        # the sign itself can come back from its three bytes
        return data.replace(SPACE, " ").removeprefix(" ")


_vocabularies: dict[str, Vocabulary] = {}


def encoder(path: str) -> Encoder:
    """An encoder for one task. The vocabulary stays in the worker process, the segments go with the task."""
    if path not in _vocabularies:
        _vocabularies[path] = load_vocabulary(path)
    return Encoder(_vocabularies[path])


def encode_documents(docs: DataFrame, folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, n_chars, round_trip: a row for every row of ``docs``.

    Whole texts are encoded, whatever their length; null and empty texts have no ids. ``round_trip`` says that the ids
    decode to the text (a text that itself has the sign U+2581 comes back with spaces there, so it is false). Null and
    repeated doc_ids and repeated rows stay as they are; an empty table has no rows; other columns are ignored.
    """
    path = os.path.join(folder, model)
    names = ["doc_id", "ids", "n_tokens", "n_chars", "round_trip"]

    def compute(batches):
        own = encoder(path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # steps of a bounded number of characters
                first, size, texts = at, 0, []
                while at < batch.num_rows and size < 1 << 20:
                    texts.append(batch.column(1)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                ids = own.encode_all(texts)
                same = [own.decode(i) == t for i, t in zip(ids, texts)]
                counts = np.array([len(i) for i in ids], dtype=np.int64)
                values = np.fromiter(chain.from_iterable(ids), np.int32, count=int(counts.sum()))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values))
                chars = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, at - first), lists, pa.array(counts), chars, pa.array(same)], names
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(giving_back(compute), "doc_id long, ids array<int>, n_tokens long, n_chars long, round_trip boolean")


def decode_documents(encoded: DataFrame, folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """doc_id, text: from (doc_id, ids); a null list gives a null text, an id outside the vocabulary U+FFFD."""
    path = os.path.join(folder, model)

    def compute(batches):
        own = encoder(path)
        for batch in batches:
            texts = [None if ids.as_py() is None else own.decode(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(giving_back(compute), "doc_id long, text string")
