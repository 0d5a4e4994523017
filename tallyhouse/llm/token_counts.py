"""Token counts by section: whole documents are encoded once, and tokens attributed by their spans.

A section's count is not the count of its text alone, since tokens run over boundaries; the spans of the whole
document's tokens are joined to the sections, and a token that crosses a boundary is allocated by a stated rule:
"first" to the section of its first byte, "most" to the section with most of its bytes (of equals the earlier), "split"
to each section by its share of the bytes.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files; a parameter of every function that opens one.
TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
RULES = ("first", "most", "split")
OUTSIDE = -1

# fixed value: the published split pattern of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encodings: dict = {}


def encoding(path: str):
    """(encoding, byte length of every token), one a worker process."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        made = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encodings[path] = made, lengths
    return _encodings[path]


def line_sections(data: bytes) -> np.ndarray:
    """(start, end) in bytes of every line, each with its line break."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    ends = np.r_[ends, len(data)] if not len(ends) or ends[-1] < len(data) else ends
    return np.stack([np.r_[0, ends[:-1]], ends], axis=1) if len(data) else np.zeros((0, 2), np.int64)


def attribute(token_ends: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section, and outside all sections at the end: a sorted merge of two lists of spans.

    ``sections`` are (start, end), sorted by start; where they overlap, a byte belongs to the later one.
    """
    counts = np.zeros(len(sections) + 1)
    if not len(token_ends):
        return counts
    token_starts = np.r_[0, token_ends[:-1]]
    # the sections and the gaps between them cut the text into stretches
    starts = sections[:, 0]
    ends = np.minimum(sections[:, 1], np.r_[starts[1:], np.iinfo(np.int64).max]) if len(sections) else sections[:, 1]
    cuts = np.unique(np.r_[0, starts, ends, token_ends[-1]])
    cuts = cuts[cuts <= token_ends[-1]]
    at = np.searchsorted(starts, cuts[:-1], "right") - 1
    owner = np.where((at >= 0) & (cuts[:-1] < ends[np.maximum(at, 0)]), at, len(sections)) if len(sections) else np.zeros(len(cuts) - 1, np.int64)
    first = np.searchsorted(cuts, token_starts, "right") - 1
    if rule == "first":
        np.add.at(counts, owner[first], 1)
        return counts
    last = np.searchsorted(cuts, token_ends, "left") - 1
    inside = first == last
    np.add.at(counts, owner[first[inside]], 1)
    for token in np.flatnonzero(~inside).tolist():
        pieces = np.arange(first[token], last[token] + 1)
        size = np.minimum(cuts[pieces + 1], token_ends[token]) - np.maximum(cuts[pieces], token_starts[token])
        if rule == "split":
            np.add.at(counts, owner[pieces], size / size.sum())
        else:
            share = np.zeros(len(counts))
            np.add.at(share, owner[pieces], size)
            best = owner[pieces][np.argmax(share[owner[pieces]])]
            counts[best] += 1
    return counts


def count_by_section(
    docs: DataFrame, rule: str = "first", sections: str | None = None, folder: str = TOKENIZERS, ranks: str = RANKS
) -> DataFrame:
    """doc_id, section, start, end, n_tokens, doc_tokens: a row for each section of each row of ``docs``.

    Sections are the lines of the text, each with its line break, or those of the column ``sections``, an array of
    (start, end) in characters (parts beyond the text are cut off; null parts are left out); start and end are
    characters. Tokens outside all sections make a row with section -1 and no place, if there are any. The counts of a
    document's rows add up to doc_tokens; they are doubles, since the rule "split" gives shares. Null and empty texts
    have one row with section -1 and no tokens. Repeated rows stay repeated, null doc_ids null; an empty table has no
    rows, and other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = os.path.join(folder, ranks)
    names = ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"]

    def compute(batches):
        own, lengths = encoding(path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                columns: list[list] = [[] for _ in names]
                size = 0
                while at < batch.num_rows and size < 1 << 20:
                    text = batch.column(1)[at].as_py() or ""
                    data = text.encode("utf-8", "surrogatepass")
                    ends = np.cumsum(lengths[np.array(own.encode_ordinary(text), dtype=np.int64)])
                    # characters before each byte
                    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                    place = np.r_[0, np.cumsum(lead)]
                    if sections is None:
                        spans = line_sections(data)
                    else:
                        given = [(s["start"], s["end"]) for s in batch.column(2)[at].as_py() or [] if s]
                        given = [(max(0, s), min(len(text), e)) for s, e in given if s is not None and e is not None]
                        given = np.array(sorted((s, e) for s, e in given if s < e), dtype=np.int64).reshape(-1, 2)
                        byte = np.r_[np.flatnonzero(lead), len(data)]
                        spans = byte[given]
                    counts = attribute(ends, spans, rule)
                    numbers = [*range(len(spans))]
                    n = counts[:-1].tolist()
                    starts, stops = (place[spans[:, i]].tolist() for i in range(2))
                    if counts[-1] or not numbers:
                        numbers, n = [*numbers, OUTSIDE], [*n, float(counts[-1])]
                        starts, stops = [*starts, None], [*stops, None]
                    doc_id = batch.column(0)[at].as_py()
                    for column, values in zip(columns, ([doc_id] * len(n), numbers, starts, stops, n, [len(ends)] * len(n))):
                        column.extend(values)
                    size += len(data)
                    at += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    chosen = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if sections is not None:
        chosen.append(F.col(sections).cast("array<struct<start:long,end:long>>").alias("parts"))
    schema = "doc_id long, section int, start long, end long, n_tokens double, doc_tokens long"
    return docs.select(*chosen).mapInArrow(compute, schema)
