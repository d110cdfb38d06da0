"""Best-fit packing: best-two-fit over pieces of tokenised documents.

Every document is encoded once and cut only if it is longer than a sequence. What is packed
are rows of piece lengths, dealt by hash into blocks of about BLOCK pieces, so that no task
holds more than that whatever the input; each block leaves at most one sequence ill-filled.
A block is filled sequence by sequence: the longest piece that fits, again and again; then,
if room is left, the smallest piece in the sequence gives way to the two unpacked pieces that
fill the widened gap best, if they fill it better.

Defined results: a null text is an empty one and has the end token only. Null and repeated
ids are packed like others, row by row. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiband.llm.common import kept, texts_of
from lexiband.llm.common import pieces as smaller

CAPACITY, END_ID, BLOCK, WORDS = 4096, 1, 1 << 14, 300_000
# Texts in which white space alone parts what the tokenizer sees: printable ASCII and Latin-1.
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xac\xae-\xff]*")
STOP = re.compile(r"[.,](?<=(?:[^\w\s]|_)[.,])\s")  # looked for from its rarer end
BLANKS = " \n\t\r\x0b\x0c"
# What READS splits a plain word in lower case into.
LETTERS, NUMERALS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMERALS}]|[^\s{LETTERS}{NUMERALS}]+")
# How a tokenizer reads a text if words can be encoded apart from one another, lower
# case, white space dropped, and what it splits words at.
READS = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class Numbers(dict):
    """Word to number, given out in order."""

    def __init__(self):
        super().__init__()
        self.order: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.order)
        self.order.append(word)
        return number


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    A tokenizer that READS so drops white space and never looks across it, so the ids of a plain text are
    those of its words one after the other. Words are encoded once and remembered; new ones
    go to the tokenizer's own model together, split as it READS, so that no normalising and splitting of
    any Unicode is paid for; a control character that plain texts don't have parts them. Beyond `words`
    of them, the half that was used longest ago is forgotten. Any other text, and every text of any
    other tokenizer, goes to the tokenizer whole.
    """

    def __init__(self, path: str, words: int = WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.words, self.batch = Tokenizer.from_file(path), words, 0
        told = json.loads(self.tokenizer.to_str())
        reads = {
            "normalizer": (told["normalizer"] or {}).get("normalizers"),
            "pre_tokenizer": (told["pre_tokenizer"] or {}).get("pretokenizers"),
        }
        mark = self.tokenizer.encode("\x02", add_special_tokens=False).ids
        added = all("<|" in token["content"] for token in told["added_tokens"])  # no plain text that goes by words has one
        self.by_words = reads == READS and len(mark) == 1 and told["model"]["type"] == "BPE" and added
        self.mark = mark[0] if mark else None
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.of_parts = Tokenizer(self.tokenizer.model)  # the model is shared, not copied
        self.of_parts.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), in_bytes])
        # The ids of all words one after the other, and of each word where, how many, last used when.
        self.numbers, self.held = Numbers(), np.empty(0, "<u4")
        self.starts, self.lengths, self.used = (np.empty(0, np.int64) for _ in range(3))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._words(text) for text in texts]
        if len(self.numbers) > self.words:
            self._forget()
        before = len(self.numbers)
        found = map(self.numbers.__getitem__, chain.from_iterable(words for words in split if words))
        numbers = np.fromiter(found, np.int64)
        self._learn(self.numbers.order[before:])
        self.batch += 1
        self.used[numbers] = self.batch
        sizes = self.lengths[numbers]
        ends = np.cumsum(sizes)
        ids = self.held[np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        out, word = [], 0
        for text, words in zip(texts, split):
            if words is None:
                out.append(self._ids(text).tobytes())
                continue
            first, word = word, word + len(words)
            out.append(ids[ends[first] - sizes[first] : ends[word - 1]].tobytes() if words else b"")
        return out

    def _words(self, text: str) -> list[str] | None:
        if not self.by_words or not PLAIN.fullmatch(text) or "<|" in text:
            return None
        text = text.lower() + "\n"
        if not STOP.search(text):  # then every , and . before white space is a token of its own
            for blank in BLANKS:
                if blank in text:
                    text = text.replace("." + blank, " ." + blank).replace("," + blank, " ," + blank)
        return text.split()

    def _learn(self, words: list[str], at_once: int = 500) -> None:
        ids, sizes = [self.held], [self.lengths]
        for i in range(0, len(words), at_once):
            some = [word if word.isalpha() else " ".join(PARTS.findall(word)) for word in words[i : i + at_once]]
            found = self._ids(" \x02 ".join(some), self.of_parts)
            parts = np.flatnonzero(found == self.mark)
            ids.append(found[found != self.mark])
            sizes.append(np.diff(parts, prepend=-1, append=len(found)) - 1)
        if words:
            self.held, self.lengths = np.concatenate(ids), np.concatenate(sizes)
            self.starts = np.cumsum(self.lengths) - self.lengths
            self.used = np.concatenate([self.used, np.zeros(len(words), np.int64)])

    def _forget(self) -> None:
        kept_ = np.flatnonzero(self.used > np.median(self.used))
        order, numbers = self.numbers.order, Numbers()
        for number in kept_.tolist():
            numbers[order[number]]
        ids = [self.held[self.starts[i] : self.starts[i] + self.lengths[i]] for i in kept_.tolist()]
        self.numbers, self.lengths, self.used = numbers, self.lengths[kept_], self.used[kept_]
        self.held = np.concatenate([self.held[:0], *ids])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _ids(self, text: str, tokenizer=None) -> np.ndarray:
        (encoding,) = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, dtype="<u4")


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, words: int = WORDS) -> Encoder:
    """One per Python worker, as reading the vocabulary takes longer than many texts."""
    if (path, words) not in _encoders:
        _encoders[path, words] = Encoder(path, words)
    return _encoders[path, words]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    capacity: int = CAPACITY,
    with_ids: bool = False,
    words: int = WORDS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its `ids` if asked for. A Python worker
    remembers the ids of `words` words."""
    fields = [
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ]
    end, width = np.array([END_ID], dtype="<u4").tobytes(), 4 * capacity

    def cut(batches):
        encode = encoder(tokenizer, words).encode
        for batch, texts in texts_of(smaller(batches), "text"):
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, data in enumerate(encode(texts)):
                data += end
                for k in range(0, len(data), width):
                    part = data[k : k + width]
                    rows.append(row)
                    piece.append(k // width)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
            columns = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in fields])

    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return wanted.mapInArrow(cut, T.StructType(fields))


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; lengths are 1 to `capacity`."""
    by_length = np.argsort(lengths, kind="stable")
    stock = np.bincount(lengths, minlength=capacity + 1)
    upto = np.cumsum(stock)  # the pieces of a length are taken from the end of its run
    sizes = np.arange(capacity + 1)
    floor = np.maximum.accumulate(np.where(stock > 0, sizes, 0))  # longest length left up to a room
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def take(size: int) -> None:
        stock[size] -= 1
        if not stock[size]:
            floor[size : np.searchsorted(floor, size, "right")] = floor[size - 1]

    left, sequence = len(lengths), 0
    while left:
        held, room = [], capacity
        while room and (size := int(floor[room])):
            take(size)
            held.append(size)
            room -= size
        if room and len(held) > 1:
            gap = room + held[-1]
            one = np.flatnonzero(stock[: gap // 2 + 1])
            if len(one):
                other = floor[gap - one]
                twice = (other == one) & (stock[one] < 2)  # a length of which one piece is left can't pair with itself
                total = np.where(twice | (other == 0), 0, one + other)
                best = int(np.argmax(total))
                if total[best] > held[-1]:
                    give = held.pop()
                    stock[give] += 1
                    if stock[give] == 1:
                        floor[give : np.searchsorted(floor, give)] = give
                    for size in (int(one[best]), int(other[best])):
                        take(size)
                        held.append(size)
        at = 0
        for size in held:
            upto[size] -= 1
            row = by_length[upto[size]]
            number[row], offset[row] = sequence, at
            at += size
        left -= len(held)
        sequence += 1
    return number, offset


def packed(pieces_: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """The pieces with the sequence they lie in and their place there, gapless from 0."""
    numbered = kept(pieces_.withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, round(numbered.count() / block))
    dealt = numbered.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("long"))
    schema = T.StructType(
        [
            *(field for field in numbered.schema.fields if field.name != "_row"),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack(key, table):
        order = np.argsort(table.column("_row").to_numpy())  # the table, ids and all, is not copied
        number, offset = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        number[order], offset[order] = best_two_fit(table.column("length").to_numpy()[order], capacity)
        number += key[0].as_py() << 32
        table = table.drop_columns(["_row", "_block"]).append_column("sequence_id", pa.array(number))
        return table.append_column("offset", pa.array(offset))

    return dealt.groupBy("_block").applyInArrow(pack, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    capacity: int = CAPACITY,
    with_ids: bool = False,
    words: int = WORDS,
) -> DataFrame:
    """Cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the pieces'
    `ids` before these two if asked for."""
    return packed(pieces(docs, tokenizer, text, doc_id, capacity, with_ids, words), capacity)
