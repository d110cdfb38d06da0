"""Phrase collocations by FM-indexes over word ids.

Every task indexes its texts in shards of one group (a language) and about WORDS words. A
shard's words are numbered; its text is the row of these numbers, 0 between pieces. Kept are
the Burrows-Wheeler transforms of the row and of the row reversed, sorted by as many symbols as
a phrase has words at most, which is what intervals of phrases need. From the transform
come ranks, and from ranks the interval of a phrase in either index: its length is the phrase's
count, and the symbols in it are the words that come before (in the reversed index: after) the phrase.

Phrases are found word by word. Words are counted in all shards and summed; those that are
frequent enough as a whole go back to the shards, which extend them to the right, in the reversed index. The pairs are summed in turn, and the frequent ones
go back and are extended to the left, in the other index, and so on. As a phrase is no more frequent than its parts, nothing is lost, and no shard lists what can't be frequent. Sums are exact over all texts.

Bounds: a shard has about WORDS words, as a piece is never cut; a group, whatever its size, is
many shards. A word or phrase sends one row per shard where it occurs. What goes to
a shard is bounded by its own words. The best of a group are picked in every task first.

Defined results: null and empty texts have no words, a null group is "und". Repeated rows
count each time. Order is total: score, count, then the phrase in the order of its bytes.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiband.llm.common import kept, small, stored

WORDS, PART, LONGEST, LEAST, COVERED, BEST, SCALE = 1 << 19, 1 << 20, 3, 10, 50, 2000, 1_000_000
UNKNOWN = "und"
# A-Z in lower case, every mark that ends a piece a line feed, a tab a blank: then white space
# within a piece is blanks alone.
ENDS = b".,;:!?\x0b\x0c\r"
READ = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(ENDS)
)


class Half:
    """One transform with its ranks."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.symbols, self.size, self.rows = symbols, size, len(symbols)
        # Symbol and row in one number, ascending: a search among them is a rank.
        self.keys = np.sort(symbols.astype(np.int64) * (self.rows + 1) + np.arange(self.rows))
        self.first = self.before(np.arange(size + 1), np.zeros(size + 1, np.int64))

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row that a symbol at or after `row` of the transform leads to."""
        return np.searchsorted(self.keys, symbol.astype(np.int64) * (self.rows + 1) + row)

    def interval(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of each phrase; its words come in the order in which they are put before one another."""
        low, high = self.first[phrases[:, 0]], self.first[phrases[:, 0] + 1]
        for word in phrases.T[1:]:
            low, high = self.before(word, low), self.before(word, high)
        return low, high

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For disjoint intervals: which, a symbol in it, and how often, which is the size of the
        interval of the phrase with that symbol before it."""
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
        found, counts = np.unique(which * self.size + self.symbols[rows], return_counts=True)
        return found // self.size, found % self.size, counts


def transformed(row: np.ndarray, size: int, depth: int) -> np.ndarray:
    """The symbols before the row's suffixes, these sorted by their first `depth` symbols, equals
    by place."""
    bits = len(row).bit_length()
    key, bound = row.astype(np.int64), size
    for i in range(1, depth):
        if bound * size >= 1 << (63 - bits):
            key, bound = ranked(key, bits), len(row)
        key, bound = key * size + np.roll(row, -i), bound * size
    return np.roll(row, 1)[np.sort((key << bits) + np.arange(len(row))) & ((1 << bits) - 1)]


def ranked(key: np.ndarray, bits: int) -> np.ndarray:
    """Each key's rank among the distinct ones. Key and place in one number sort fastest."""
    places = np.sort((key << bits) + np.arange(len(key)))
    out = np.empty_like(key)
    out[places & ((1 << bits) - 1)] = np.cumsum(np.diff(places >> bits, prepend=-1) > 0) - 1
    return out


class Index:
    """Both halves of a shard. Words are given as numbers from 1; 0 is between pieces."""

    def __init__(self, forward: np.ndarray | None, backward: np.ndarray | None, size: int):
        self.size = size
        self.forward, self.backward = (None if half is None else Half(half, size) for half in (forward, backward))

    @classmethod
    def of(cls, row: np.ndarray, size: int, depth: int = LONGEST) -> Index:
        return cls(transformed(row, size, depth), transformed(row[::-1], size, depth), size)

    def left(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the distinct phrases (a row of words each), a word before it, and how often."""
        return self._words(*self.forward.extended(*self.forward.interval(phrases[:, ::-1])))

    def right(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the distinct phrases, a word after it, and how often."""
        return self._words(*self.backward.extended(*self.backward.interval(phrases)))

    @staticmethod
    def _words(which, symbol, counts):
        words = symbol > 0
        return which[words], symbol[words], counts[words]


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


class Shard:
    """Texts of one group on their way into an index."""

    def __init__(self):
        self.numbers, self.row = Numbers(), array("i", [0])

    def add(self, text: bytes) -> None:
        number = self.numbers.__getitem__
        for piece in text.translate(READ).split(b"\n"):
            before = len(self.row)
            for part in parts(piece):
                self.row.extend(map(number, part.split()))
            if len(self.row) > before:
                self.row.append(0)

    def indexed(self, shard: int, group: str, depth: int) -> pa.RecordBatch:
        row, size = np.frombuffer(self.row, np.int32), len(self.numbers) + 1
        halves = [packed(transformed(one, size, depth)) for one in (row, row[::-1])]
        counts = np.bincount(row, minlength=size)[1:]
        columns = [
            pa.array([shard], pa.int64()),
            pa.array([group], pa.string()),
            pa.array([[word.decode("utf-8", "replace") for word in self.numbers]], pa.list_(pa.string())),
            pa.array([counts], pa.list_(pa.int64())),
            *(pa.array([half], pa.binary()) for half in halves),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "grp", "words", "counts", "forward", "backward"])


def packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes apart, which compresses best."""
    apart = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(apart).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def parts(piece: bytes) -> Iterator[bytes]:
    """A long piece in parts that cut no word."""
    while len(piece) > PART:
        at = piece.rfind(b" ", 0, PART)
        at = piece.find(b" ", PART) if at < 0 else at
        if at < 0:
            break
        yield piece[:at]
        piece = piece[at + 1 :]
    yield piece


def shards(docs: DataFrame, text: str, group: Column, depth: int = LONGEST, words: int = WORDS) -> DataFrame:
    """shard, grp, words, counts, forward, backward: an index per row, kept."""

    def made(batches):
        open_: dict[str, Shard] = {}
        number, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, name in enumerate(batch.column("grp").to_pylist()):
                if value := texts[i].as_py():
                    shard = open_.setdefault(name, Shard())
                    before = len(shard.row)
                    shard.add(value)
                    held += len(shard.row) - before
                while held >= words:
                    largest = max(open_, key=lambda key: len(open_[key].row))
                    done = open_.pop(largest)
                    held -= len(done.row) - 1
                    yield done.indexed(number, largest, depth)
                    number += 1
        for name, shard in open_.items():
            if shard.numbers:
                yield shard.indexed(number, name, depth)
                number += 1

    rows = docs.select(F.coalesce(group.cast("string"), F.lit(UNKNOWN)).alias("grp"), F.col(text).alias("text"))
    schema = "shard long, grp string, words array<string>, counts array<long>, forward binary, backward binary"
    return stored(rows.mapInArrow(made, schema), "phrase-shards")


def names(length: int) -> list[str]:
    """Columns of a phrase: the numbers of its words."""
    return [f"w{i}" for i in range(length)]


def keys(length: int, base: int) -> list[str]:
    """Columns that a phrase is told by: one number where that fits, as it sorts and travels best."""
    return ["code"] if base**length < 1 << 63 else names(length)


def coded(phrases: np.ndarray, columns: list[str], base: int) -> list[np.ndarray]:
    """The columns of `keys`."""
    length = phrases.shape[1]
    if len(columns) == length:
        return list(phrases.T)
    return [phrases @ np.array([base**i for i in reversed(range(length))], np.int64)]


def decoded(table: pa.Table, columns: list[str], length: int, base: int) -> np.ndarray:
    values = [table.column(name).to_numpy() for name in columns]
    if len(values) < length:
        values = [values[0] // base**i % base for i in reversed(range(length))]
    return np.stack(values, 1)


def told_by_words(phrases: DataFrame, length: int, base: int) -> DataFrame:
    """w0, w1, ..., n"""
    if len(keys(length, base)) == length:
        return phrases.select(*names(length), "n")
    words = [F.expr(f"code div {base ** (length - 1 - i)}L % {base}L").alias(name) for i, name in enumerate(names(length))]
    return phrases.select(*words, "n")


def counted_words(indexes: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(w0, grp, word, n) of the frequent words of all shards, numbered from 1, and, a row
    a shard, (shard, number): the vocabulary's for each of the shard's own, 0 for none.

    The words of all shards are shuffled once. They lie side by side in a partition, where they are
    summed and numbered as they pass; a partition's first number is how many those before it have.
    """
    words = indexes.select("shard", "grp", F.posexplode(F.arrays_zip("words", "counts")).alias("own", "at")).select(
        "grp", F.col("at.words").alias("word"), "shard", (F.col("own") + 1).alias("own"), F.col("at.counts").alias("n")
    )

    def summed(batches):
        part, place, waiting = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if waiting is None else pa.concat_tables([waiting, table])).combine_chunks()
            if table.num_rows:
                starts = word_starts(table)
                waiting = table.slice(starts[-1])  # its word may go on
                place, some = frequent_words(table.slice(0, starts[-1]), starts[:-1], part, place, least)
                yield from some.to_batches()
        if waiting is not None:
            yield from frequent_words(waiting, np.zeros(1, np.int64), part, place, least)[1].to_batches()

    schema = "shard long, own int, part int, place long, grp string, word string, n long"
    dealt = words.repartition("grp", "word").sortWithinPartitions("grp", "word")
    found = stored(dealt.mapInArrow(summed, schema), "phrase-words")
    # A row for each partition of the shuffle.
    sizes = found.groupBy("part").agg((F.max("place") + 1).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    numbered = found.join(F.broadcast(kept(firsts)), "part").withColumn("w0", F.col("first") + F.col("place") + 1)

    def gathered(key, table):
        own, numbers = table.column("own").to_numpy(), table.column("w0").to_numpy()
        number = np.zeros(own.max() + 1, np.int64)
        number[own] = numbers
        return pa.table({"shard": [key[0].as_py()], "number": pa.array([packed(number)], pa.binary())})

    vocabulary = stored(numbered.where("word IS NOT NULL").select("w0", "grp", "word", "n"), "phrase-vocabulary")
    places = numbered.select("shard", "own", "w0").groupBy("shard")
    return vocabulary, stored(places.applyInArrow(gathered, "shard long, number binary"), "phrase-numbers")


def word_starts(table: pa.Table) -> np.ndarray:
    """The rows where another word begins than in the row before."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in ("grp", "word"):
        column = table.column(name).combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def frequent_words(table: pa.Table, starts: np.ndarray, part: int, place: int, least: int) -> tuple[int, pa.Table]:
    """The rows of the words that are frequent, numbered from `place`, and the next number. A word's
    first row has its group, itself and its count."""
    sizes = np.diff(starts, append=table.num_rows)
    counts = np.add.reduceat(table.column("n").to_numpy(), starts) if len(starts) else np.empty(0, np.int64)
    many = counts >= least
    numbers = place + np.cumsum(many) - 1
    rows = np.flatnonzero(np.repeat(many, sizes))
    first = np.zeros(table.num_rows, bool)
    first[starts] = True
    some, first = table.take(pa.array(rows)), pa.array(~first[rows])
    columns = {
        "shard": some.column("shard"),
        "own": some.column("own"),
        "part": pa.array(np.full(len(rows), part, np.int32)),
        "place": pa.array(np.repeat(numbers, sizes)[rows]),
        "grp": pc.replace_with_mask(some.column("grp"), first, pa.scalar(None, pa.string())),
        "word": pc.replace_with_mask(some.column("word"), first, pa.scalar(None, pa.string())),
        "n": pa.array(np.repeat(counts, sizes)[rows]),
    }
    return place + int(many.sum()), pa.table(columns)


def longer(indexes: DataFrame, numbers: DataFrame, frequent: DataFrame | None, length: int, base: int) -> DataFrame:
    """shard, the phrase, n: the phrases of `length` words in each shard of which all words, and both
    parts that are one word shorter, are frequent. `frequent` has those parts per shard; without
    it they are the words."""
    side = "backward" if frequent is None else "forward"
    rows = indexes.select("shard", F.size("words").alias("size"), F.col(side).alias("half")).join(numbers, "shard")
    told, shorter = keys(length, base), keys(length - 1, base)
    columns = ["shard", *told, "n"]
    schema = ", ".join(f"{name} long" for name in columns)

    def found(index, given):
        size = index.column("size")[0].as_py() + 1
        half, some = (unpacked(index.column(name)[0].as_py(), kind) for name, kind in (("half", np.int32), ("number", np.int64)))
        number = np.zeros(size, np.int64)
        number[: len(some)] = some
        one = Index(None, half, size) if given is None else Index(half, None, size)
        phrases, counts = extended(one, number, given)
        values = [np.full(len(counts), index.column("shard")[0].as_py()), *coded(phrases, told, base), counts]
        return pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)) for value in values], names=columns)

    if frequent is None:

        def from_words(batches):
            for batch in batches:
                yield from (found(batch.slice(i, 1), None) for i in range(batch.num_rows))

        return rows.mapInArrow(from_words, schema)

    def from_parts(index, given):
        if not index.num_rows or not given.num_rows:
            return pa.schema([(name, pa.int64()) for name in columns]).empty_table()
        return pa.Table.from_batches([found(index, decoded(given, shorter, length - 1, base))])

    parts_ = frequent.select("shard", *shorter)
    return rows.groupBy("shard").cogroup(parts_.groupBy("shard")).applyInArrow(from_parts, schema)


def extended(index: Index, number: np.ndarray, given: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Phrases one word longer than those given, in numbers of the vocabulary, and their counts.
    `number` has the vocabulary's for each of the shard's own, 0 for none."""
    known = np.flatnonzero(number)
    if given is None:  # words, to the right
        which, symbol, counts = index.right(known[:, None])
        wanted = number[symbol] > 0
        return np.stack([number[known[which]], number[symbol]], 1)[wanted], counts[wanted]
    order = known[np.argsort(number[known])]
    own = order[np.searchsorted(number[order], given)]
    which, symbol, counts = index.left(own)
    wanted = number[symbol] > 0
    which, symbol, counts = which[wanted], symbol[wanted], counts[wanted]
    if index.size ** given.shape[1] < 1 << 62:  # the part without the last word is frequent as well
        radix = index.size ** np.arange(given.shape[1] - 1, -1, -1)
        first = np.concatenate([symbol[:, None], own[which, :-1]], 1) @ radix
        wanted = np.isin(first, own @ radix)
        which, symbol, counts = which[wanted], symbol[wanted], counts[wanted]
    return np.concatenate([number[symbol][:, None], given[which]], 1), counts


def frequent_phrases(
    docs: DataFrame, text: str, group: Column, longest: int = LONGEST, least: int = LEAST, words: int = WORDS
) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(grp, n) the words of each group, the vocabulary, and for each length the phrases that occur
    `least` times: (w0, ..., n), the first being the words."""
    indexes = shards(docs, text, group, longest, words)
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda held, n: held + n)
    sizes = kept(indexes.groupBy("grp").agg(F.sum(total).alias("n")))
    vocabulary, numbers = counted_words(indexes, least)
    tables, frequent, base = [vocabulary.select("w0", "n")], None, vocabulary.count() + 1
    for length in range(2, longest + 1):
        found, columns = longer(indexes, numbers, frequent, length, base), keys(length, base)
        if length == longest:
            summed = found.groupBy(*columns).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            tables.append(stored(told_by_words(summed, length, base), "phrases"))
            break
        # One row per shard and phrase, so no phrase has more rows than there are shards.
        same = Window.partitionBy(*columns)
        sums = found.withColumns({"n": F.sum("n").over(same), "once": F.col("shard") == F.min("shard").over(same)})
        frequent = stored(sums.where(F.col("n") >= least), "phrases-in-shards")
        tables.append(told_by_words(frequent.where("once"), length, base))
    return sizes, vocabulary, tables


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    best: int = BEST,
    words: int = WORDS,
) -> DataFrame:
    """The group, rank, phrase, a, l, r, n, score of the `best` phrases of each group.

    A phrase with count a is cut in two of counts l and r where SCALE * a * a / (l * r) is least.
    It is left out if a phrase one word longer has `covered` hundredths of its occurrences or
    more; still longer ones have no more than that one.
    """
    sizes, vocabulary, tables = frequent_phrases(docs, text, F.col(group), longest, least, words)
    parts_ = [_phrases(tables, vocabulary, length, covered) for length in range(2, longest + 1)]
    scored = reduce(DataFrame.unionByName, parts_)
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(small(sizes), "grp").select(
        F.col("grp").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _phrases(tables: Sequence[DataFrame], vocabulary: DataFrame, length: int, covered: int) -> DataFrame:
    """grp, phrase, a, l, r, score of the phrases of `length` words that no longer one covers."""
    columns = names(length)
    rows = tables[length - 1].withColumnRenamed("n", "a")
    if length < len(tables):
        above = tables[length]
        sides = [above.select(*(F.col(f"w{i + shift}").alias(f"w{i}") for i in range(length)), "n") for shift in (0, 1)]
        most = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.max("n").alias("longer"))
        rows = rows.join(most, columns, "left").where(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
        ).drop("longer")
    spelled = small(vocabulary.select("w0", "grp", "word", F.col("n").alias("f")))
    for i, name in enumerate(columns):
        given = spelled.select(
            F.col("w0").alias(name), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}_{i + 1}"), *(["grp"] if not i else [])
        )
        rows = rows.join(given, name)
    for start in range(length):
        for end in range(start + 2, length + 1):
            if end - start < length and (start == 0 or end == length):
                size = end - start
                part = tables[size - 1].select(
                    *(F.col(f"w{i}").alias(f"w{start + i}") for i in range(size)), F.col("n").alias(f"f{start}_{end}")
                )
                rows = rows.join(part, columns[start:end])
    # At most 16 digits each, so that the products are exact in 38.
    exact = {name: F.col(name).cast("decimal(15,0)") for name in rows.columns if name == "a" or name.startswith("f")}
    rows = rows.withColumns({f"_{name}": value for name, value in exact.items()})
    cuts = []
    for k in range(1, length):
        left, right = f"f0_{k}", f"f{k}_{length}"
        score = F.expr(f"(_a * _a * CAST({SCALE} AS DECIMAL(8,0))) div (_{left} * _{right})")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")))
    cut = F.array_min(F.array(*cuts))
    words = [F.col(f"word{i}") for i in range(length)]
    return rows.withColumn("_cut", cut).select(
        "grp", F.concat_ws(" ", *words).alias("phrase"), "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"),
        F.col("_cut.score").alias("score"),
    )
