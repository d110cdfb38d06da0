"""Token counts by offset-mapped attribution.

A text is encoded once, as a whole. A byte-level vocabulary gives each token's number of
bytes, and their running sum the token's span; mapped to characters, the spans are joined
to the sections of the text as intervals. A token that crosses a boundary goes to the section
(or the gap between two) that has most of its characters, and to the earlier one of equals.
So the counts of a text's sections and gaps add up to the tokens of the whole text, which
counting the sections one by one would not.

Sections are lines unless a column of character spans is given. Spark deals the texts out;
the join of one text is a search in its sorted boundaries, in one task.

Defined results: a null text is empty: one section with no tokens if sections are lines.
Characters outside every section count as section -1, a row that is there whenever it has
tokens. Sections must not overlap; null, empty and reversed ones have no characters and get
no tokens. Repeated and null ids get their rows like others. Other columns are not read.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTSIDE = -1
# How the pattern of a byte-level vocabulary ends if it takes a run of white space but
# for its last character, and what it takes for white space.
BLANKS_END = r"\s+(?!\S)|\s+"
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{BLANK}]{{1000,}}")


class Spans:
    """Encodes texts and knows where each token lies.

    The pattern's look-ahead goes back through a run of white space step by step, which a very long
    run does not survive. Such a run is one piece up to its last character, or whole at the
    end of a text; so it is encoded apart, as one piece, and the ids are those of the whole text.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # The same vocabulary with everything as one piece.
        self.one_piece = tiktoken.Encoding("runs", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.cuts_runs = pattern.endswith(BLANKS_END)
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def characters(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last."""
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        ids = self.ids(text)
        ends = np.cumsum(self.sizes[ids])
        if not len(ids):
            return ends, ends
        number = np.cumsum((data & 0xC0) != 0x80) - 1  # of the character that a byte is part of
        return number[ends - self.sizes[ids]], number[ends - 1] + 1


    def ids(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for run in LONG_RUN.finditer(text) if self.cuts_runs else ():
            end = run.end() - (run.end() < len(text))
            parts.append(self.encoding.encode_to_numpy(text[at : run.start()]))
            parts.append(self.one_piece.encode_to_numpy(text[run.start() : end]))
            at = end
        return np.concatenate([*parts, self.encoding.encode_to_numpy(text[at:])]).astype(np.int64)


_spans: dict[str, Spans] = {}


def spans(path: str, pattern: str) -> Spans:
    """One per Python worker."""
    if path not in _spans:
        _spans[path] = Spans(path, pattern)
    return _spans[path]


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line, without its line feed."""
    lengths = np.array([len(line) for line in text.split("\n")], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    return ends - lengths, ends


def attributed(
    first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary; sections are sorted."""
    some = np.flatnonzero(ends > starts)
    cuts = np.unique(np.concatenate([[0], starts[some], ends[some], [max(length, 1)]]))[:-1]
    at = np.searchsorted(starts[some], cuts, "right") - 1  # the last section that starts here or before
    inside = (at >= 0) & (cuts < ends[some][at]) if len(some) else np.zeros(len(cuts), bool)
    names = np.where(inside, some[at] if len(some) else OUTSIDE, OUTSIDE)
    low = np.searchsorted(cuts, first, "right") - 1
    high = np.searchsorted(cuts, after - 1, "right") - 1
    crossing = low != high
    chosen = low.copy()
    bounds = np.append(cuts, max(length, 1))
    for i in np.flatnonzero(crossing).tolist():
        parts = np.arange(low[i], high[i] + 1)
        held = np.minimum(bounds[parts + 1], after[i]) - np.maximum(bounds[parts], first[i])
        chosen[i] = parts[int(np.argmax(held))]
    return names[chosen], crossing


def section_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    sections: Column | None = None,
) -> DataFrame:
    """doc_id, section, start, end, tokens, crossing, doc_tokens: a row for each section, by
    number from 0, and one for what is outside, if anything is.

    `sections` is an array of structs of two characters, start and end, in ascending order.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("section", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("tokens", T.LongType()),
            T.StructField("crossing", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        *([sections.alias("sections")] if sections is not None else []),
    )

    by_lines = sections is None

    def counted(batches):
        encode = spans(vocabulary, pattern).characters
        for batch in batches:
            given = None if by_lines else batch.column("sections").to_pylist()
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 512):  # a text may have many lines
                parts = []
                for row in range(at, min(at + 512, len(texts))):
                    body = texts[row] or ""
                    starts, ends = line_sections(body) if given is None else _given(given[row])
                    first, after = encode(body)
                    section, crossing = attributed(first, after, starts, ends, len(body))
                    n = np.bincount(section + 1, minlength=len(starts) + 1)
                    crossed = np.bincount(section[crossing] + 1, minlength=len(starts) + 1)
                    own = np.arange(0 if n[0] else 1, len(n))
                    parts.append(
                        [
                            np.full(len(own), row),
                            own - 1,
                            np.append(0, starts)[own],
                            np.append(len(body), ends)[own],
                            n[own],
                            crossed[own],
                            np.full(len(own), len(first)),
                        ]
                    )
                row, *values = (np.concatenate(column) for column in zip(*parts))
                columns = [batch.column("doc_id").take(pa.array(row.astype(np.int64)))]
                columns.append(pa.array(values[0].astype(np.int32)))
                columns += [pa.array(value.astype(np.int64)) for value in values[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(counted, schema).withColumnRenamed("doc_id", doc_id)


def _given(sections: list | None) -> tuple[np.ndarray, np.ndarray]:
    pairs = [tuple((part or {}).values()) for part in sections or ()]
    pairs = [(pair[0], pair[1]) if len(pair) > 1 and None not in pair[:2] else (0, 0) for pair in pairs]
    table = np.array(pairs, np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]
