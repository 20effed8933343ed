"""Word and character counts, byte-pair merges and the vocabulary table."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechloom.functions.text import strip_text, words
from speechloom.schema import CONTROL_PIECES, MERGES
from speechloom.workspace import discard, fresh_dir, written_at

WORD_START = "▁"
UNKNOWN = "\x03"
FIRST_PIECE = 0x110000  # characters go by their code points, pieces by the numbers from here
CANDIDATES = 65_536  # pairs brought to the driver at a time
LEADING = 512  # of these, pairs that a round chooses from
WORDS_PER_TASK = 200_000
FEW_WORDS = 5_000  # that are not worth a task of their own
PENDING = 48  # merges per round
PAIRS_HELD = 1 << 20  # pairs that a task sums up at a time
WORDS_PER_PACK = 20_000
MANY = 0.1  # merges per word of the text after which the packs are written anew
_PAIRS = "left string, right string, n bigint"
_PAIR_NUMBERS = "left int, right int, n bigint"
_PACKS = "symbols binary, sizes binary, n binary"
_POSTED = "seam bigint, symbols array<int>, n bigint"


def corpus_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Stripped transcripts; missing and empty ones are left out, blank ones stay as ''."""
    return df.where(F.col(text) != "").select(strip_text(F.col(text)).alias("text"))


def word_frequencies(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over white-space words, each with the word-start mark in front."""
    return (
        corpus.select(F.explode(words(F.col(text))).alias("w"))
        .groupBy(F.concat(F.lit(WORD_START), F.col("w")).alias("word"))
        .agg(F.count("*").alias("n"))
    )


def char_frequencies(frequencies: DataFrame) -> DataFrame:
    return (
        frequencies.select(F.explode(F.split("word", "")).alias("char"), "n")
        .where(F.col("char") != "")
        .groupBy("char")
        .agg(F.sum("n").alias("n"))
    )


def char_coverage(frequencies: DataFrame, coverage: float = 0.9999) -> DataFrame:
    """Smallest set of most frequent characters that covers ``coverage`` of the text."""
    return _covered(char_frequencies(frequencies), coverage).where("covered").select("char", "n")


def _covered(chars: DataFrame, coverage: float) -> DataFrame:
    # the alphabet is bounded by Unicode, so this one-partition window is too
    before = Window.orderBy(F.col("n").desc(), "char").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    reached = F.coalesce(F.sum("n").over(before), F.lit(0)) / F.sum("n").over(everything)
    return chars.withColumn("covered", reached < coverage)


def independent_merges(
    top: list[tuple[int, str, str]], complete: bool, known: set[str], limit: int
) -> list[tuple[int, str, str]]:
    """Leading pairs that one-merge-at-a-time training would also take next, in this order.

    ``top`` is sorted by count descending, then left, then right. Merging (a, b) changes only pairs
    that begin with b or end with a, and a pair with the new symbol is never more frequent than the
    changed pair it comes from. So the next pair of the list is still the best one as long as no
    changed pair has at least its count. Anything undecidable from the list ends the batch.
    """
    chosen: list[tuple[int, str, str]] = []
    lefts: set[str] = set()
    rights: set[str] = set()

    def changed(pair):
        return pair[1] in rights or pair[2] in lefts

    for i, pair in enumerate(top):
        if len(chosen) == limit:
            break
        count, left, right = pair
        if chosen:
            tied = [p for p in top[i:] if p[0] == count]
            beyond = not complete and top[-1][0] == count
            if beyond or any(changed(p) for p in tied):
                break
        chosen.append(pair)
        lefts.add(left)
        rights.add(right)
        piece = left + right
        undecided = left == right or piece in known
        known.add(piece)
        if undecided:
            break
    return chosen


def numbered_words(frequencies: DataFrame, uncovered: list[str]) -> DataFrame:
    """``symbols, n`` of words of several characters, as code points; those outside the alphabet become one mark.

    Three control characters are never part of the alphabet.
    """
    outside = "".join(dict.fromkeys([*uncovered, "\x01", "\x02", UNKNOWN]))
    word = F.translate("word", outside, UNKNOWN * len(outside))
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    return frequencies.select(F.transform(chars, F.ascii).alias("symbols"), "n").where(F.size("symbols") > 1)


class Symbols:
    """Numbers and strings of symbols, and the merges in numbers; small enough to go along with every task."""

    def __init__(self):
        self.pieces: list[str] = []
        self.number: dict[str, int] = {}

    def of(self, symbol: str) -> int:
        if len(symbol) == 1:
            return ord(symbol)
        if symbol not in self.number:
            self.number[symbol] = FIRST_PIECE + len(self.pieces)
            self.pieces.append(symbol)
        return self.number[symbol]

    def merges(self, pairs: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
        return [(self.of(left), self.of(right), self.of(left + right)) for left, right in pairs]

    def name(self, number: int) -> str:
        return chr(number) if number < FIRST_PIECE else self.pieces[number - FIRST_PIECE]

    def ends(self, symbols: np.ndarray, place: int) -> np.ndarray:
        """Code points of the first (0) or last (-1) characters of symbols."""
        table = np.array([ord(p[place]) for p in self.pieces] or [0], np.int64)
        return np.where(symbols < FIRST_PIECE, symbols, table[np.maximum(symbols - FIRST_PIECE, 0)])


def seam(last: str | np.ndarray, first: str | np.ndarray):
    """The number of a seam, where the last character of a symbol meets the first of the next."""
    if isinstance(last, str):
        last, first = ord(last[-1]), ord(first[0])
    return last * FIRST_PIECE + first


class Rules:
    """Merges in their order, none of them twice, to be looked up by their pairs all at once."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        left, right, self.pieces = np.array(merges, np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]
        self.left, self.right = (np.bincount(x, minlength=1).astype(bool) for x in (left, right))

    def places(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the merges' pairs in words, and the rank of each."""
        most = max(len(self.left), len(self.right), int(symbols.max(initial=0)) + 1)
        self.left, self.right = (x if len(x) == most else np.pad(x, (0, most - len(x))) for x in (self.left, self.right))
        at = np.flatnonzero(self.left[symbols[:-1]] & self.right[symbols[1:]] & (owner[:-1] == owner[1:]))
        keys = symbols[at] << 32 | symbols[at + 1]
        found = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        there = self.keys[found] == keys
        return at[there], self.rank[found[there]]


def rules(merges: list[tuple[int, int, int]]) -> list[Rules]:
    """Merges cut where a pair comes once more, as it may after another way to one of its symbols."""
    parts: list[dict[tuple[int, int], int]] = [{}]
    for left, right, piece in merges:
        if (left, right) in parts[-1]:
            parts.append({})
        parts[-1][left, right] = piece
    return [Rules([(*pair, piece) for pair, piece in part.items()]) for part in parts if part]


class Words:
    """The words of an Arrow batch as one row of symbols; ``owner`` has the word of each."""

    def __init__(self, column: pa.Array):
        sizes = np.diff(column.offsets.to_numpy())
        self.symbols = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)

    def merge(self, merges: list[tuple[int, int, int]]) -> None:
        """Apply merges one after the other, each from left to right, to all words."""
        self.apply(rules(merges))

    def apply(self, parts: list[Rules]) -> None:
        """The same by rules: each word goes from one merge that it has to the next, all words at a time.

        A word changes at the first merge after its last one whose pair it has, and stays as it is between them.
        """
        for part in parts:
            where = np.flatnonzero(self.having(part)[self.owner])
            if not len(where):
                continue
            s, o, place = self.symbols[where], self.owner[where], where
            last, ended = np.full(self.owner[-1] + 1, -1), []
            while True:
                at, rank = part.places(s, o)
                later = rank > last[o[at]]
                at, rank = at[later], rank[later]
                if not len(at):
                    break
                going = np.zeros(len(last), bool)
                going[o[at]] = True
                going = going[o]
                if 2 * np.count_nonzero(going) < len(s):
                    ended.append((place[~going], s[~going]))
                    at = (np.cumsum(going) - 1)[at]
                    s, o, place = s[going], o[going], place[going]
                starts = np.flatnonzero(np.diff(o[at], prepend=-1))
                first = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(at)))
                at, rank = at[rank == first], rank[rank == first]
                # of a run of overlapping places every other one counts
                starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                run = np.repeat(starts, np.diff(starts, append=len(at)))
                other = (np.arange(len(at)) - run) % 2 == 0
                at, rank = at[other], rank[other]
                s[at] = part.pieces[rank]
                last[o[at]] = rank
                kept = np.ones(len(s), bool)
                kept[at + 1] = False
                s, o, place = s[kept], o[kept], place[kept]
            kept = np.ones(len(self.symbols), bool)
            kept[where] = False
            for place, s in [*ended, (place, s)]:
                self.symbols[place] = s
                kept[place] = True
            self.symbols, self.owner = self.symbols[kept], self.owner[kept]

    def having(self, *parts: Rules) -> np.ndarray:
        """A mask of the words that have a pair of some merges."""
        words = np.zeros(self.owner[-1] + 1 if len(self.owner) else 0, bool)
        for part in parts:
            words[self.owner[part.places(self.symbols, self.owner)[0]]] = True
        return words

    def only(self, words: np.ndarray) -> "Words":
        """The words that a mask names, under their old numbers."""
        out = object.__new__(Words)
        kept = words[self.owner]
        out.symbols, out.owner = self.symbols[kept], self.owner[kept]
        return out

    def neighbours(self) -> np.ndarray:
        """Places whose symbol has another of its word behind it."""
        return np.flatnonzero(self.owner[:-1] == self.owner[1:])

    def pairs(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of neighbours, as (left, right) rows, and the counts of their words."""
        at = self.neighbours()
        both = np.stack([self.symbols[at], self.symbols[at + 1]], axis=1)
        known = (both != ord(UNKNOWN)).all(axis=1)
        return both[known], n[self.owner[at]][known]

    def lists(self, words: np.ndarray) -> pa.Array:
        """The named words as an Arrow list column."""
        sizes = np.bincount(self.owner, minlength=len(words))
        offsets = np.concatenate([[0], np.cumsum(sizes[words])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.symbols[words[self.owner]].astype(np.int32)))


def _totals(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs, as (left, right) rows, with their summed counts, without those that come to nothing."""
    both = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    n = np.concatenate(counts) if counts else np.empty(0, np.int64)
    there = np.zeros(int(both.max(initial=0)) + 1, bool)
    there[both.reshape(-1)] = True
    numbers = np.flatnonzero(there)
    if len(numbers) ** 2 <= 8 * len(both):
        place = np.cumsum(there) - 1
        # sums of whole numbers stay exact in doubles below 2 ** 53
        total = np.bincount(place[both[:, 0]] * len(numbers) + place[both[:, 1]], n, len(numbers) ** 2).astype(np.int64)
        kept = np.flatnonzero(total)
        return np.stack([numbers[kept // len(numbers)], numbers[kept % len(numbers)]], axis=1), total[kept]
    keys = both[:, 0] << 32 | both[:, 1]
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    total = np.add.reduceat(n[order], starts) if len(starts) else np.empty(0, np.int64)
    keys = keys[starts][total != 0]
    return np.stack([keys >> 32, keys & 0xFFFFFFFF], axis=1), total[total != 0]


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray], symbols: Symbols) -> pa.RecordBatch:
    """Pairs with their summed counts, by name."""
    kept, total = _totals(pairs, counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([symbols.name(x) for x in kept[:, i].tolist()], pa.string()) for i in (0, 1)]
        + [pa.array(total)], ["left", "right", "n"])


def _numbered(pairs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """Pairs with their summed counts, by number."""
    kept, total = _totals(pairs, counts)
    return pa.RecordBatch.from_arrays([pa.array(kept[:, i].astype(np.int32)) for i in (0, 1)] + [pa.array(total)], ["left", "right", "n"])


def pair_counts(words: DataFrame, symbols: Symbols, merges: list[tuple[int, int, int]]) -> DataFrame:
    """``left, right, n`` over neighbouring symbols of all words after some merges."""

    def run(batches):
        parts = rules(merges)
        for rows in batches:
            w = Words(rows.column("symbols"))
            w.apply(parts)
            pairs, n = w.pairs(rows.column("n").to_numpy())
            yield _summed([pairs], [n], symbols)

    return words.select("symbols", "n").mapInArrow(run, _PAIRS).groupBy("left", "right").agg(F.sum("n").alias("n"))


class Postings:
    """Inverted table from seams to words, in the order of the seams.

    A merge can only change words that have its seam, so a round reads these postings alone. Words are
    kept as they were when the table was written; a task brings them up to date with the merges since.
    From time to time the table is written again without the seams that have been merged away.
    """

    def __init__(self, words: DataFrame, slices: int, symbols: Symbols):
        s = F.col("symbols")
        left, right = (F.transform(x, lambda c: c.cast("bigint")) for x in (F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1)))
        known = F.when((F.size(s) > 1), F.zip_with(left, right, lambda a, b: F.when(
            (a != ord(UNKNOWN)) & (b != ord(UNKNOWN)), a * FIRST_PIECE + b)))
        posted = words.select(F.explode(F.array_distinct(F.array_compact(known))).alias("seam"), "symbols", "n")
        self.spark, self.path, self.symbols = words.sparkSession, fresh_dir(words.sparkSession, "postings"), symbols
        self.since: list[tuple[str, str]] = []
        # each file has a share of the words, in the order of the seams: a frequent seam is read by all tasks
        self.table = written_at(posted.repartition(slices, "symbols").sortWithinPartitions("seam"), self.path)

    def changes(self, batch: list[tuple[str, str]]) -> list[tuple[str, str, int]]:
        """What the merges of a batch add to the count of each pair; bounded by batch and vocabulary."""
        seams = list(dict.fromkeys(seam(left, right) for left, right in batch))
        # always more values than Spark compiles one by one, so that all rounds share their code
        asked = F.col("seam").isin(*seams, *(-i for i in range(1, 13)))
        symbols, order = self.symbols, np.argsort(seams)
        since, now = symbols.merges(self.since), symbols.merges(batch)

        def run(batches):
            pairs, counts = [], []
            for rows in batches:
                n, own = rows.column("n").to_numpy(), rows.column("seam").to_numpy()
                w = Words(rows.column("symbols"))
                w.merge(since)
                # a word that has several of the seams is looked at under the first of them
                at = w.neighbours()
                found = seam(symbols.ends(w.symbols[at], -1), symbols.ends(w.symbols[at + 1], 0))
                place = np.searchsorted(seams, found, sorter=order).clip(max=len(seams) - 1)
                place = np.where(np.array(seams)[order][place] == found, order[place], len(seams))
                first = np.full(rows.num_rows, len(seams))
                np.minimum.at(first, w.owner[at], place)
                w = w.only(np.append(seams, -1)[first] == own)
                before, times = w.pairs(n)
                w.merge(now)
                after, times_after = w.pairs(n)
                pairs += [before, after]
                counts += [-times, times_after]
                if sum(map(len, counts)) > PAIRS_HELD:
                    yield _summed(pairs, counts, symbols)
                    pairs, counts = [], []
            yield _summed(pairs, counts, symbols)

        told = self.table.where(asked).mapInArrow(run, _PAIRS)
        self.since = self.since + batch
        return [tuple(r) for r in told.groupBy("left", "right").agg(F.sum("n").alias("n")).where("n != 0").collect()]

    def compact(self) -> None:
        """Bring the words up to date and leave out seams and words that no merge can change any more."""
        symbols, since = self.symbols, self.symbols.merges(self.since)

        def run(batches):
            for rows in batches:
                own = rows.column("seam").to_numpy()
                w = Words(rows.column("symbols"))
                w.merge(since)
                at = w.neighbours()
                there = seam(symbols.ends(w.symbols[at], -1), symbols.ends(w.symbols[at + 1], 0)) == own[w.owner[at]]
                kept = np.bincount(w.owner[at], there, rows.num_rows) > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[kept]), w.lists(kept), pa.array(rows.column("n").to_numpy()[kept])], ["seam", "symbols", "n"])

        older, self.path = self.path, fresh_dir(self.spark, "postings")
        self.table = written_at(self.table.mapInArrow(run, _POSTED), self.path)
        self.since = []
        discard(self.spark, older)


def packed(found: list[tuple[Words, np.ndarray]]) -> pa.RecordBatch:
    """Words of several symbols, with their counts, as one row; no merge can change the others."""
    symbols, sizes, counts = [np.empty(0)], [np.empty(0)], [np.empty(0)]
    for w, n in found:
        size = np.bincount(w.owner, minlength=len(n))
        symbols.append(w.symbols[(size > 1)[w.owner]])
        sizes.append(size[size > 1])
        counts.append(n[size > 1])
    columns = ((symbols, np.int32), (sizes, np.int32), (counts, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array([np.concatenate(x).astype(kind).tobytes()], pa.binary()) for x, kind in columns], ["symbols", "sizes", "n"])


def unpacked(rows: pa.RecordBatch):
    """The words of each row and their counts."""
    for symbols, sizes, n in zip(*(rows.column(x) for x in ("symbols", "sizes", "n"))):
        w = object.__new__(Words)
        sizes = np.frombuffer(sizes.as_buffer(), np.int32)
        w.symbols = np.frombuffer(symbols.as_buffer(), np.int32).astype(np.int64)
        w.owner = np.repeat(np.arange(len(sizes)), sizes)
        yield w, np.frombuffer(n.as_buffer(), np.int64)


class Packs:
    """All words, many to a row, so that a round goes over them in few steps and each is kept once.

    Words are kept as they were when the table was written; a task brings them up to date with the merges
    since. From time to time the table is written again, without words that have become one symbol.
    """

    def __init__(self, words: DataFrame, symbols: Symbols):
        def run(batches):
            held, many = [], 0
            for rows in batches:
                held.append((Words(rows.column("symbols")), rows.column("n").to_numpy()))
                many += rows.num_rows
                if many >= WORDS_PER_PACK:
                    yield packed(held)
                    held, many = [], 0
            if held:
                yield packed(held)

        self.spark, self.path, self.symbols = words.sparkSession, fresh_dir(words.sparkSession, "packs"), symbols
        self.since: list[tuple[str, str]] = []
        self.table = written_at(words.select("symbols", "n").mapInArrow(run, _PACKS), self.path)

    def changes(self, batch: list[tuple[str, str]]) -> list[tuple[str, str, int]]:
        """What the merges of a batch add to the count of each pair; bounded by batch and vocabulary."""
        merged, merging, name = self.symbols.merges(self.since), self.symbols.merges(batch), self.symbols.name

        def run(batches):
            since, now = rules(merged), rules(merging)
            pairs, counts = [], []
            for rows in batches:
                for w, n in unpacked(rows):
                    w.apply(since)
                    w = w.only(w.having(*now))
                    before, times = w.pairs(n)
                    w.apply(now)
                    after, times_after = w.pairs(n)
                    pairs += [before, after]
                    counts += [-times, times_after]
                    if sum(map(len, counts)) > PAIRS_HELD:
                        yield _numbered(pairs, counts)
                        pairs, counts = [], []
            yield _numbered(pairs, counts)

        told = self.table.mapInArrow(run, _PAIR_NUMBERS).groupBy("left", "right").agg(F.sum("n").alias("n")).where("n != 0")
        self.since = self.since + batch
        return [(name(left), name(right), n) for left, right, n in zip(*(x.to_pylist() for x in told.toArrow().columns))]

    def compact(self) -> None:
        """Bring the words up to date and leave out those that no merge can change any more."""
        merged = self.symbols.merges(self.since)

        def run(batches):
            since = rules(merged)
            for rows in batches:
                for w, n in unpacked(rows):
                    w.apply(since)
                    yield packed([(w, n)])

        older, self.path = self.path, fresh_dir(self.spark, "packs")
        self.table = written_at(self.table.mapInArrow(run, _PACKS), self.path)
        self.since = []
        discard(self.spark, older)


class Pairs:
    """The most frequent pairs with their counts, on the driver: at most ``CANDIDATES`` and those made since.

    Pairs that are not listed have at most ``floor``; it is 0 if all are listed. Counts of unlisted pairs
    can only fall, but for pairs with a symbol that a merge arrives at once more.
    """

    def __init__(self, counts: DataFrame):
        rows = [tuple(r) for r in counts.orderBy(F.desc("n"), "left", "right").limit(CANDIDATES + 1).collect()]
        self.first = rows[:1]
        self.floor = rows[-1][2] if len(rows) > CANDIDATES else 0
        self.counts = {(left, right): n for left, right, n in rows if n > self.floor}

    def top(self, n: int) -> tuple[list[tuple[int, str, str]], bool]:
        """The first of the pairs that are certain, and whether there are no others at all."""
        sure = [(count, *pair) for pair, count in self.counts.items() if count > self.floor]
        least = heapq.nlargest(n, (count for count, _, _ in sure))[-1:]
        leading = sorted((x for x in sure if x[0] >= least[0]), key=lambda x: (-x[0], x[1], x[2]))[:n]
        return leading, len(sure) <= n and not self.floor

    def change(self, changes: list[tuple[str, str, int]], made: set[str]) -> None:
        for left, right, n in changes:
            pair = (left, right)
            if pair in self.counts or left in made or right in made or not self.floor:
                count = self.counts.get(pair, 0) + n
                if count > 0:
                    self.counts[pair] = count
                else:
                    self.counts.pop(pair, None)


def train_bpe(
    frequencies: DataFrame,
    merges: int,
    coverage: float = 0.9999,
    table_every: int = 8,
) -> list[tuple[int, str, str, str, int]]:
    """Learn byte-pair merges from a word-frequency table until there are ``merges`` pieces.

    Returns rank, left, right, piece and count per merge; ties go to the smaller left, then right.
    Pairs are counted over all distinct words once, and the most frequent ones come to the driver. Each
    round takes every merge that is certain to come next, goes over the packed words and gets back what
    they change. The packs are written anew every ``table_every`` rounds, or sooner where merges since
    then have taken place in many words. Pairs are counted over all words again only where the listed
    ones no longer tell. ``frequencies`` is read several times, so it should be a stored table.
    """
    spark = frequencies.sparkSession
    # words are short but cost many pairs each, so partitions are sized by words, not by bytes
    n_words, occurrences = frequencies.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    slices = max(-(-n_words // WORDS_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-n_words // FEW_WORDS)), 1)
    chars = _covered(char_frequencies(frequencies), coverage)
    uncovered = [r[0] for r in chars.where("NOT covered").select("char").collect()]
    table, symbols = fresh_dir(spark, "bpe"), Symbols()
    words = written_at(numbered_words(frequencies, uncovered).repartition(slices), table)
    packs = Packs(words, symbols)
    learned: list[tuple[int, str, str, str, int]] = []

    def counted() -> Pairs:
        return Pairs(pair_counts(words, symbols, symbols.merges([(left, right) for _, left, right, _, _ in learned])))

    pairs, fresh, known, rounds, since = counted(), True, set(), 0, 0
    while len(known) < merges:
        top, complete = pairs.top(LEADING)
        if not top and pairs.floor and not fresh:
            pairs, fresh = counted(), True
            top, complete = pairs.top(LEADING)
        if not top and pairs.first:
            # every listed pair is as frequent as some that are not: only the first is certain
            top, complete = [(n, left, right) for left, right, n in pairs.first], False
            pairs.counts = {}
        batch = independent_merges(top, complete, known, min(PENDING, merges - len(known)))
        if not batch:
            break
        again = {left + right for _, left, right in batch} & {piece for *_, piece, _ in learned}
        for count, left, right in batch:
            learned.append((len(learned), left, right, left + right, count))
        pairs.change(packs.changes([(left, right) for _, left, right in batch]), {x + y for _, x, y in batch} - again)
        fresh, pairs.first = False, []
        if again and pairs.floor:
            pairs, fresh = counted(), True
        rounds += 1
        since += sum(count for count, _, _ in batch)
        if rounds == table_every or since > MANY * occurrences:
            packs.compact()
            rounds, since = 0, 0
    discard(spark, table)
    discard(spark, packs.path)
    return learned


def merges_table(spark: SparkSession, learned: list) -> DataFrame:
    return spark.createDataFrame(learned, MERGES)


def vocabulary(spark: SparkSession, learned: list, chars: DataFrame) -> DataFrame:
    """``id, piece, rank``: control pieces, merged pieces in rank order, then characters by frequency.

    A piece that several merges arrive at is listed once. Sizes are those of a vocabulary.
    """
    pieces = list(CONTROL_PIECES)
    ranks: list[int | None] = [None] * len(pieces)
    for rank, _, _, piece, _ in learned:
        if piece not in pieces:
            pieces.append(piece)
            ranks.append(rank)
    head = spark.createDataFrame(
        [(i, p, r) for i, (p, r) in enumerate(zip(pieces, ranks))], "id int, piece string, rank int"
    )
    position = F.row_number().over(Window.orderBy(F.col("n").desc(), "char"))
    tail = chars.select(
        (position + F.lit(len(pieces) - 1)).cast("int").alias("id"),
        F.col("char").alias("piece"),
        F.lit(None).cast("int").alias("rank"),
    )
    return head.unionByName(tail)
