"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

The CGK random walk (Chakraborty, Goldenberg, Koucky 2016) reads a window and, by a random bit for each step and
symbol, stays or moves on; after an edit two walks soon meet again, so that strings at a small edit distance become
strings at a small Hamming distance. Sampled steps of the walk are a key; windows of documents and of benchmark items
with one key are candidates, and their edit distance is computed. Windows of documents start at words and, inside long
words, at even distances; those of items wherever such a window can meet them, also amid a word. So an item has many
chances; repetitions with other random bits are added until edited copies of all lengths are found with the target recall.

The benchmark is the stated query set. It is read in blocks of bounded bytes, and a block goes to all tasks, which read
the documents where they lie: nothing is shuffled, and no document's windows leave its task.
"""

from __future__ import annotations

import functools
import math
import random
import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back

#: Bytes of benchmark texts that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20
#: An item is found in a text within this share of its bytes in edits.
MAX_EDITS = 0.2
TARGET_RECALL = 0.95
MOST_REPETITIONS = 24
#: Steps of a walk; items too short for it use a shorter one, of which SAMPLED steps make a key.
STEPS, SAMPLED = 40, 14
#: Steps of the whole walk that one look-up takes; all but one of the bytes between look-ups make a key.
STRIDE = 3
#: After so many samples, windows whose samples no item has are given up.
EARLY = (5, 7, 9)
SEED = 11
#: The low bits of a packed walk: its place in its block of texts. Keys have zeros there.
_PLACE_BITS = 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
#: What a sampled byte adds to a key, by its turn.
_MARKS = np.random.default_rng(SEED).integers(0, 1 << 64, (SAMPLED, 256), dtype=np.uint64) & ~_PLACE
_TABLE_BITS = 20
_CHUNK = 1 << 20
#: Windows that go through all repetitions before the next ones do: so many stay in a core's cache.
_WINDOWS = 1 << 16
_GRAMS = 1 << 12


def normalise(text: str) -> bytes:
    """Lower case, one space between words, UTF-8: what distances are measured in."""
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


@functools.lru_cache(1024)
def _symbol_bits(pattern: bytes) -> dict[int, int]:
    """For each byte the bits of its places."""
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def edit_distance_in(pattern: bytes, text: bytes, most: int | None = None) -> tuple[int, int]:
    """(distance, end): the least edits that turn the pattern into some substring of the text, and its first end.

    Myers' bit-parallel columns, in one whole number of len(pattern) bits. With ``most``, a distance beyond it may come
    out too large: what is left of the text, each byte of which takes one edit away at best, is not read then.
    """
    m = len(pattern)
    masks = _symbol_bits(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    limit = m + len(text) if most is None else most + len(text)
    for at, c in enumerate(text):
        if score > limit - at:
            break
        eq = masks.get(c, 0)
        vertical = eq | minus
        eq = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ((eq | plus) ^ full)
        down = plus & eq
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = full & (up << 1)  # a match may begin anywhere
        down = full & (down << 1)
        plus = down | ((vertical | up) ^ full)
        minus = up & vertical
        if score < best:
            best, end = score, at + 1
    return best, end


def edit_match(item: bytes, text: bytes, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best occurrence of the item within ``most`` edits, or none."""
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    distance, end = edit_distance_in(item, text, most)
    if distance > most:
        return None
    back = text[max(0, end - len(item) - distance) : end][::-1]
    return distance, end - edit_distance_in(item[::-1], back)[1], end


def gram_counts(data: np.ndarray) -> np.ndarray:
    """How often each hash of three successive bytes stands in a text."""
    if len(data) < 3:
        return np.zeros(_GRAMS, np.int64)
    code = data[:-2].astype(np.int64) * 961 + data[1:-1].astype(np.int64) * 31 + data[2:]
    return np.bincount(code & (_GRAMS - 1), minlength=_GRAMS)


# ---- keys -----------------------------------------------------------------------------------------------------------


def word_places(data: np.ndarray) -> np.ndarray:
    """How far each byte lies behind the start of its word; -1 for spaces and texts' ends (0)."""
    at = np.arange(len(data), dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    behind = np.where((data == 32) | (data == 0), at, at.dtype.type(-1))
    return at - np.maximum.accumulate(behind, out=behind) - 1


def text_starts(places: np.ndarray, steps: int) -> np.ndarray:
    """Where windows of documents start: at words, and in them at distances that leave a start in any item's windows."""
    apart = max(1, steps // 5)
    starts = places == 0
    amid = np.flatnonzero(places >= apart)  # few: most words are shorter
    starts[amid[places[amid] % apart == 0]] = True
    return np.flatnonzero(starts)


def item_starts(data: np.ndarray, steps: int) -> np.ndarray:
    """Where windows of an item start: wherever one of a document may. The word that holds the item's first byte may
    have begun before it, and edits move places in long words, so that all bytes there are starts."""
    places = word_places(data)
    amid = (places >= max(1, steps // 5)) | (places == np.arange(len(data)))
    return np.flatnonzero((places == 0) | ((places >= 0) & amid))


def step_codes(data: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """For each byte itself (or its rank) and, in four bits each, the classes of the two behind it: what a walk's next steps
    depend on."""
    low = np.r_[data & 15, np.zeros(2, np.uint8)].astype(np.uint16)
    return (data.astype(np.uint16) if rank is None else rank[data]) << 8 | low[1:-1] << 4 | low[2:]


class Ranks:
    """The bytes of items in successive numbers; other bytes share one for each class, since no item has them."""

    def __init__(self, texts: list[bytes]):
        self.own = np.unique(np.frombuffer(b"".join(texts), np.uint8))
        self.rank = np.arange(256, dtype=np.uint16) & 15
        self.rank[self.own] = 16 + np.arange(len(self.own))
        self.classes = np.r_[np.arange(16), self.own & 15]

    def marks(self, turn: int) -> np.ndarray:
        """By rank what a sampled byte adds to a key; no item's key has that of the other bytes."""
        return np.r_[np.full(16, ~_MARKS[turn, self.own].sum() & ~_PLACE), _MARKS[turn, self.own]]


class Walk:
    """One repetition: random bits for each step and class of symbols (sixteen, by the low bits), and the sampled steps."""

    def __init__(self, steps: int, seed: int):
        draw = np.random.default_rng([SEED, steps, seed])
        self.steps = steps
        moves = draw.integers(0, 2, (steps, 16), dtype=np.int8)
        self.stride = STRIDE if steps == STEPS else 1
        if self.stride > 1:
            every = np.arange(0, steps, self.stride)
            self.sampled = np.delete(every, draw.integers(len(every)))
        else:
            # one step of each equal stretch: neighbours often repeat a symbol
            strata = np.array_split(np.arange(steps), min(SAMPLED, steps))
            self.sampled = np.array([draw.choice(part) for part in strata])
        self.last = int(self.sampled[-1])
        # a window is never left: its walk moves at most ``last`` places
        self.reach = self.last + 1
        # by look-up, how many samples are taken then, or none
        turn_of = {step: taken for taken, step in enumerate(self.sampled.tolist(), 1)}
        self.taken = [turn_of.get(step, 0) for step in range(0, self.reach, self.stride)]
        # by the classes of three bytes, how far the steps until the next look-up move
        code = np.arange(16**STRIDE)
        classes = np.stack([code >> 8, code >> 4 & 15, code & 15])
        self.jumps = []
        for step in range(0, self.last, self.stride):
            moved = np.zeros(len(code), np.int8)
            for own in moves[step : step + self.stride]:
                moved += own[classes[moved, code]]
            self.jumps.append(moved)

    def keys(self, codes: np.ndarray, starts: np.ndarray, early: dict[int, np.ndarray] | None = None, samples: int | None = None, begun: tuple | None = None):
        """(place in starts, key) of the windows; with the tables ``early``, only of those that pass them.

        ``codes`` are the texts', which must go on for ``reach`` bytes behind every start. ``samples`` ends the walk there;
        ``begun`` is what ``begin`` found.
        """
        first, who, at, key = begun or (0, None, starts.astype(np.int64), np.zeros(len(starts), dtype=np.uint64))
        last = max(self.taken) if samples is None else min(samples, max(self.taken))
        for turn in range(first, len(self.taken)):
            taken = self.taken[turn]
            code = codes.take(at, mode="clip")
            if taken:
                key += _MARKS[taken - 1].take(code >> 8, mode="clip")
            if taken == last:
                break
            if early and taken in early:
                alive = np.flatnonzero(early[taken].take(_slot(key, len(early[taken]).bit_length() - 1), mode="clip"))
                at, key, code, who = at[alive], key[alive], code[alive], alive if who is None else who[alive]
            at += self.jumps[turn].take(code & 0xFFF, mode="clip")
        return np.arange(len(starts)) if who is None else who, key

    def looks(self, ranks: Ranks, early: dict[int, np.ndarray]) -> list[np.ndarray]:
        """The look-ups until the first of the tables ``early`` is asked, each as one table by code (with ranks): the mark of
        the byte, and in its low bits how far the walk moves."""
        out = []
        for turn in range(self.taken.index(min(early)) + 1 if early else 0):
            moved = self.jumps[turn][ranks.classes[:, None] << 8 | np.arange(256)].astype(np.uint64)
            out.append((moved + (ranks.marks(self.taken[turn] - 1)[:, None] if self.taken[turn] else 0)).astype(np.uint64).ravel())
        return out

    @staticmethod
    def begin(codes: np.ndarray, starts: np.ndarray, at_start: np.ndarray, early: dict[int, np.ndarray], looks: list[np.ndarray]) -> tuple | None:
        """The windows that pass the first of the tables ``early``, for ``keys``; key and place of a walk are one number.

        ``codes`` (with ranks) begin at the first start, and end less than 2 ** _PLACE_BITS behind it; those ``at_start`` are
        the same for all walks.
        """
        if not looks:
            return None
        state = (starts - starts[0]).view(np.uint64) + looks[0].take(at_start, mode="clip")
        place, code, look = np.empty_like(state), np.empty(len(state), codes.dtype), np.empty_like(state)
        for table in looks[1:]:
            np.bitwise_and(state, _PLACE, out=place)
            codes.take(place.view(np.int64), out=code, mode="clip")
            state += table.take(code, out=look, mode="clip")
        passed = early[min(early)]
        alive = np.flatnonzero(passed.take(_slot(state, len(passed).bit_length() - 1), mode="clip"))
        state = state[alive]
        place = state & _PLACE
        return len(looks), alive, place.view(np.int64) + starts[0], state - place

    def early_tables(self, codes: np.ndarray, starts: np.ndarray) -> dict[int, np.ndarray]:
        tables = {}
        for samples in EARLY:
            if samples < len(self.sampled):
                # some 16 slots and more a window: they prune alike, and a task holds those of all repetitions
                bits = min(_TABLE_BITS, len(starts).bit_length() + 4)
                tables[samples] = np.zeros(1 << bits, dtype=bool)
                tables[samples][_slot(self.keys(codes, starts, samples=samples)[1], bits)] = True
        return tables


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).view(np.int64)


def steps_for(length: int) -> int:
    """Steps of the walk over an item: a walk must end within a window of the item."""
    steps = STEPS
    while steps > 1 and steps * 2 > length:
        steps //= 2
    return steps


@dataclass
class Side:
    """Walks of one length, and for each of these repetitions the keys of the items that need it."""

    steps: int
    walks: list[Walk] = field(default_factory=list)
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, np.ndarray]]] = field(default_factory=list)


def _length_class(length: int) -> int:
    """Lengths that differ by less than a fifth, of which the recall is measured together."""
    return int(4 * math.log2(length))


def _item_windows(texts: list[bytes], items: list[int], walk: Walk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All items as one buffer, with the starts of their windows: (codes, starts, item, offset)."""
    starts, owner, offset, parts, size, reach = [], [], [], [], 0, walk.reach
    for i in items:
        data = np.frombuffer(texts[i], np.uint8)
        own = item_starts(data, walk.steps)
        own = own[(own + reach <= len(data)) | (own == 0)]
        starts.append(own + size)
        owner.append(np.full(len(own), i))
        offset.append(own)
        parts.append(texts[i] + b"\0" * reach)
        size += len(parts[-1])
    return (step_codes(np.frombuffer(b"".join(parts), np.uint8)), *(np.concatenate(x).astype(np.int64) for x in (starts, owner, offset)))


def edited(text: bytes, share: float, draw: random.Random) -> bytes:
    """The text with that share of its bytes in random substitutions, insertions and deletions."""
    out = bytearray(text)
    for _ in range(int(len(text) * share)):
        at = draw.randrange(len(out)) if out else 0
        kind = draw.randrange(3)
        if kind == 0 and out:
            out[at] = draw.randrange(97, 123)
        elif kind == 1:
            out.insert(at, draw.randrange(97, 123))
        elif out:
            del out[at]
    return bytes(out)


class Searcher:
    """Keys of a block of items, as tasks use them; of the block's size."""

    def __init__(self, items: list[tuple[int, bytes]], max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.most = [int(len(t) * max_edits) for t in self.texts]
        self._grams: dict[int, np.ndarray] = {}
        self._ranks, self._looks = Ranks(self.texts), None
        by: dict[int, dict[int, list[int]]] = {}
        for i, text in enumerate(self.texts):
            by.setdefault(steps_for(len(text)), {}).setdefault(_length_class(len(text)), []).append(i)
        self.sides = [side for steps, classes in sorted(by.items()) for side in self._sides(steps, classes, max_edits, recall)]

    def _sides(self, steps: int, classes: dict[int, list[int]], max_edits: float, recall: float) -> list[Side]:
        """Repetitions are added until enough copies with the most edits allowed are found, of each class of lengths.

        A class that has its recall is asked again with fresh copies, and then needs no more repetitions. Those that
        MOST_REPETITIONS leave open go on with walks of half the steps, whose keys are shorter.
        """
        draw = random.Random(SEED)
        sides: list[Side] = []
        trials = {c: self._trials(own, max_edits, draw) for c, own in classes.items()}
        missed = dict(trials)
        while missed and (not sides or steps > 1):
            steps = steps // 2 if sides else steps
            sides.append(side := Side(steps))
            for walk in self._walks(steps, [i for c in missed for i in classes[c]]):
                codes, starts, owner, offset = _item_windows(self.texts, [i for c in missed for i in classes[c]], walk)
                key = walk.keys(codes, starts)[1]
                order = np.argsort(key, kind="stable")
                side.walks.append(walk)
                side.tables.append((key[order], owner[order], offset[order], walk.early_tables(codes, starts)))
                for c in list(missed):
                    missed[c] = self._unfound(missed[c], [(walk, side.tables[-1])])
                    if len(missed[c]) <= (1 - recall) * len(trials[c]):
                        trials[c] = self._trials(classes[c], max_edits, draw)
                        missed[c] = self._unfound(trials[c], [pair for s in sides for pair in zip(s.walks, s.tables)])
                        if len(missed[c]) <= (1 - recall) * len(trials[c]):
                            del missed[c]
                if not missed:
                    break
        for c, left in missed.items():
            size = min(len(self.texts[i]) for i in classes[c])
            warnings.warn(f"{len(left)} of {len(trials[c])} edited items of {size} bytes and more not found", stacklevel=2)
        return sides

    def _trials(self, own: list[int], max_edits: float, draw: random.Random) -> list[tuple[int, int, bytes]]:
        """(item, place, text): edited copies at that place amid other bytes, every other one inside a word."""
        letters = lambda: bytes(draw.randrange(97, 123) for _ in range(draw.randrange(40)))
        sample, out = draw.sample(own, min(len(own), 100)), []
        for i in sample:
            for n in range(max(3, 100 // len(sample))):
                before, behind = (letters(), letters()) if n % 2 else (letters() + b" ", b" " + letters())
                out.append((i, len(before), before + edited(self.texts[i], max_edits, draw) + behind))
        return out

    def _unfound(self, trials: list[tuple[int, int, bytes]], repetitions: list[tuple[Walk, tuple]]) -> list[tuple[int, int, bytes]]:
        """The trials of which no repetition has a candidate where the copy lies."""
        if not trials:
            return trials
        every = np.frombuffer(b"\0".join(t for _, _, t in trials) + b"\0", np.uint8)
        ends = np.cumsum([len(t) + 1 for _, _, t in trials])
        item = np.array([i for i, _, _ in trials])
        true = ends - [len(t) + 1 - at for _, at, t in trials]
        most = np.array(self.most)[item]
        places, found = word_places(every), np.zeros(len(trials), bool)
        codes = step_codes(np.r_[every, np.zeros(STEPS, np.uint8)])
        for walk, table in repetitions:
            owner, at, begin = self._hits(walk, table, codes, text_starts(places, walk.steps))
            trial = np.searchsorted(ends, at, "right")
            found[trial[(owner == item[trial]) & (abs(begin - true[trial]) <= most[trial])]] = True
        return [t for t, hit in zip(trials, found) if not hit]

    @staticmethod
    def _hits(walk: Walk, table: tuple, codes: np.ndarray, starts: np.ndarray, begun: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place of the window, place where the item would begin) of windows with a key of the table."""
        keys, owner, offset, early = table
        who, key = walk.keys(codes, starts, early, begun=begun)
        lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
        n = hi - lo
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(starts[who], n)
        return owner[entry], at, at - offset[entry]

    def _walks(self, steps: int, own: list[int]) -> list[Walk]:
        """The repetitions to try, from a larger draw: those that give different windows the fewest equal keys."""

        def equal_keys(walk):
            codes, starts, *_ = _item_windows(self.texts, own, walk)
            return (np.unique(walk.keys(codes, starts)[1], return_counts=True)[1] ** 2).sum()

        return sorted((Walk(steps, seed) for seed in range(2 * MOST_REPETITIONS)), key=equal_keys)[:MOST_REPETITIONS]

    def candidates(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Distinct (item, text, place where it would begin, in steps of 16 bytes) of texts that end (in a 0) at ``ends``."""
        found = [np.zeros((3, 0), np.int64)]
        places = word_places(data)
        data = np.r_[data, np.zeros(STEPS, np.uint8)]
        codes, ranked = step_codes(data), step_codes(data, self._ranks.rank)
        if self._looks is None:  # in the task, not sent to it
            self._looks = [[walk.looks(self._ranks, table[3]) for walk, table in zip(s.walks, s.tables)] for s in self.sides]
        for side, looks in zip(self.sides, self._looks):
            starts = text_starts(places, side.steps)
            first = 0
            while first < len(starts):
                end = min(first + _WINDOWS, int(np.searchsorted(starts, starts[first] + (1 << _PLACE_BITS) - 2 * STEPS)))
                block = starts[first:end]
                own, at_start = ranked[block[0] : block[-1] + STEPS], ranked[block].astype(np.int64)
                for walk, table, look in zip(side.walks, side.tables, looks):
                    owner, at, begin = self._hits(walk, table, codes, block, walk.begin(own, block, at_start, table[3], look))
                    if len(owner):
                        found.append(np.stack([owner, np.searchsorted(ends, at, "right"), begin >> 4]))
                first = end
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def grams(self, item: int) -> np.ndarray:
        if item not in self._grams:
            self._grams[item] = gram_counts(np.frombuffer(self.texts[item], np.uint8))
        return self._grams[item]

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end): for every text and item the best verified occurrence, first of equals."""
        data = b"\0".join(texts) + b"\0"
        every = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for item, text, step in self.candidates(every, ends).T.tolist():
            size, most = len(self.texts[item]), self.most[item]
            last = int(ends[text]) - 1
            first = last - len(texts[text])
            lo, hi = max(first, step * 16 - most), min(last, step * 16 + 16 + size + most)
            if hi - lo < size - most or best.get((text, item), (1,))[0] == 0:
                continue
            # an edit changes at most three of the item's grams, so that many must be there
            if np.minimum(self.grams(item), gram_counts(every[lo:hi])).sum() < size - 2 - 3 * most:
                continue
            found = edit_match(self.texts[item], data[lo:hi], most)
            if found:
                distance, start, end = found
                now = (distance, lo + start - first, lo + end - first)
                best[text, item] = min(best.get((text, item), now), now)
        return [(t, i, *found) for (t, i), found in sorted(best.items())]


def places(text: str, start: int, end: int) -> tuple[int, int]:
    """Character places in the original text of the bytes start to end of its normalised form."""
    low = ends = None
    size, gap = 0, False
    for at, char in enumerate(text):
        if char.isspace():
            gap = size > 0
            continue
        if gap:
            size, gap = size + 1, False
        if low is None and size + len(char.lower().encode("utf-8", "surrogatepass")) > start:
            low = at
        size += len(char.lower().encode("utf-8", "surrogatepass"))
        if size <= end or ends is None:
            ends = at + 1
    return low or 0, ends or 0


# ---- documents ------------------------------------------------------------------------------------------------------


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The items in blocks of at most ``block_bytes`` (or one item); items without words are left out."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        text = normalise(row["text"] or "")
        if not text:
            continue
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, h, item_id, distance, similarity, start, end: the documents that hold an item, one row for each item.

    An item is held if some passage of the text is within ``max_edits`` of its bytes in edits, both normalised (lower
    case, single spaces); start and end are characters of the text. Whole texts are searched. Null and empty texts
    hold nothing, nor is an item without words held by any. Repeated rows and items give repeated rows; null ids stay
    null. An empty table on either side gives no rows; other columns are ignored. h is a hash of the text.
    """
    spark = docs.sparkSession
    schema = "doc_id long, h long, item_id long, distance int, similarity double, start long, end long"
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"), F.col("text").cast("string")
    )
    names = ["doc_id", "h", "item_id", "distance", "similarity", "start", "end"]

    def search(searcher):
        def flush(held):
            rows: list[list] = [[] for _ in names]
            for t, i, distance, start, end in searcher.matches([n for _, _, _, n in held]):
                doc_id, h, text, _ = held[t]
                size = len(searcher.texts[i])
                start, end = places(text, start, end)
                values = (doc_id, h, searcher.ids[i], distance, 1 - distance / size, start, end)
                for column, value in zip(rows, values):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

        def run(batches):
            held, size = [], 0
            for batch in batches:
                for doc_id, h, text in zip(*(batch.column(i) for i in range(3))):
                    text = text.as_py() or ""
                    data = normalise(text)
                    held.append((doc_id.as_py(), h.as_py(), text, data))
                    size += len(data)
                    if size > _CHUNK:
                        yield flush(held)
                        held, size = [], 0
            if held:
                yield flush(held)

        return run

    found = None
    for block in item_blocks(benchmark, block_bytes):
        part = chosen.mapInArrow(giving_back(search(Searcher(block, max_edits, recall))), schema)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], schema) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; see ``find_leaks``."""
    leaks = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("l_doc_id"), F.col("h").alias("l_h")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["l_doc_id"]) & (own == leaks["l_h"]), "left_anti")
