"""Best-fit packing by large-item matching.

Token lengths are whole numbers up to the capacity, so the packing is planned on the histogram of
lengths, which never has more rows than the capacity, and each piece finds its place from its rank
among the pieces of its length. Pieces above one third of the capacity meet at most in pairs; the
smaller ones go, longest first, into the tightest gap that holds them.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from speechloom.llm.common import process_cache, slices
from speechloom.workspace import written

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
GROUP_ROWS = 50_000
LONG_SPACE = 10_000  # characters of a run of white space

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Ids of whole texts: the rank vocabulary, and its JSON form for texts that hold a special token.

    So do texts with a long run of white space, in which the rank form's pattern goes too deep.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.plain = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.spaces = re.compile(rf"\s{{{LONG_SPACE}}}")
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or len(text) >= LONG_SPACE and self.spaces.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(text)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first as long as the capacity."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def token_pieces(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID,
                 vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """One row per piece of each document: ``doc_id, piece, start, length, ids_crc32``, and ``ids`` if asked for."""

    def run(batches):
        encode = process_cache(f"encoder {vocabulary}", lambda: Encoder(vocabulary))
        for batch in slices(batches, "text"):
            rows, kept = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own.tobytes())))
                    if keep_ids:
                        kept.append(own.astype(np.int32))
            columns = [pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


class _Gaps:
    """Open bins by remaining gap: ranges of bin numbers, and the gaps in order."""

    def __init__(self):
        self.order: list[int] = []
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, n: int) -> None:
        if gap not in self.ranges:
            insort(self.order, gap)
            self.ranges[gap] = []
        self.ranges[gap].append((first, n))

    def take(self, least: int, most: int) -> tuple[int, int, int] | None:
        """Up to ``most`` bins of the tightest gap of at least ``least``: gap, first bin, number."""
        i = bisect_left(self.order, least)
        if i == len(self.order):
            return None
        gap = self.order[i]
        first, n = self.ranges[gap].pop()
        if n > most:
            self.ranges[gap].append((first + most, n - most))
            n = most
        if not self.ranges[gap]:
            del self.ranges[gap], self.order[i]
        return gap, first, n


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for all pieces: rows (length, first rank, pieces, first sequence, offset).

    Pieces of one row lie at the same offset of consecutive sequences.
    """
    left = {length: n for length, n in histogram.items() if n}
    used = dict.fromkeys(left, 0)
    places, gaps, bins = [], _Gaps(), 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        places.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        length = large[-1]
        i = bisect_left(large, capacity - length + 1) - 1
        if i >= 0 and large[i] == length and left[length] == 1:
            i -= 1
        if i < 0:
            n, partner = left[length], 0
        else:
            partner = large[i]
            n = left[length] // 2 if partner == length else min(left[length], left[partner])
        place(length, n, bins, 0)
        if partner:
            place(partner, n, bins, length)
        gaps.put(capacity - length - partner, bins, n)
        bins += n
        large = [x for x in large if left[x]]
    for length in sorted((x for x in left if left[x]), reverse=True):
        while left[length]:
            found = gaps.take(length, left[length])
            if found:
                gap, first, n = found
                place(length, n, first, capacity - gap)
                gaps.put(gap - length, first, n)
                continue
            each = capacity // length
            n, rest = divmod(left[length], each)
            if n:
                for i in range(each):
                    place(length, n, bins, i * length)
                gaps.put(capacity - each * length, bins, n)
                bins += n
            if rest:
                for i in range(rest):
                    place(length, 1, bins, i * length)
                gaps.put(capacity - rest * length, bins, 1)
                bins += 1
    return places


def pack(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY,
         keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Every document, null text as empty, becomes its ids and ``end_id``; only longer ones are cut, and
    then the first piece may be shorter than the capacity. One row per piece: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset`` (and ``ids`` on request). Repeated rows and rows without
    doc_id are packed like others; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    pieces = written(
        token_pieces(docs, capacity=capacity, end_id=end_id, vocabulary=vocabulary, keep_ids=keep_ids), "pieces"
    )
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    group = max(1, min(GROUP_ROWS, total // 512))
    salts = spark.createDataFrame(
        [(length, -(-n // group)) for length, n in histogram.items()], "length bigint, salts bigint"
    )
    # bounded by the capacity, whatever the number of documents
    places = spark.createDataFrame(
        plan(histogram, capacity),
        "length bigint, rank_from bigint, n bigint, first_sequence bigint, offset bigint",
    )
    salted = pieces.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))
    ).drop("salts")
    # ranks within (length, salt), shifted by what the smaller salts of that length hold
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("nr", F.row_number().over(own) - 1).join(shifts, ["length", "salt"]).withColumn(
        "rank", F.col("nr") + F.col("shift")
    )
    p, q = ranked.alias("p"), F.broadcast(places).alias("q")
    inside = (
        (F.col("p.length") == F.col("q.length"))
        & (F.col("p.rank") >= F.col("q.rank_from"))
        & (F.col("p.rank") < F.col("q.rank_from") + F.col("q.n"))
    )
    return p.join(q, inside).select(
        "p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32",
        (F.col("q.first_sequence") + F.col("p.rank") - F.col("q.rank_from")).alias("sequence_id"),
        F.col("q.offset").alias("offset"), *(["p.ids"] if keep_ids else []),
    )
