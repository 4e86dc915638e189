"""Best-fit packing of token sequences under several capacities.

A piece's demands are its tokens, one document slot and its attention cost
(length squared), so all pieces of one length are alike and a plan needs only
the number of pieces of each length: at most as many rows as a sequence has
tokens, whatever the corpus holds. The driver packs these counts with vector
best-fit decreasing, treating equal bins as one class with a multiplicity. Each
piece then finds its place from its rank among the pieces of its length. Ranks
come from a window over (length, salt) with the salts' counts added up, so a
length that a third of the corpus has is dealt to many tasks. The plan and the
salts' first ranks are broadcast, the latter as a table of lengths by salts whose
size is fixed: 0.5 MB for 64 salts, 34 MB for the most there can be.

``packed`` limits the documents of a sequence: to the first of 64, 128, ... that
needs no more sequences than no limit does.

Defined results: a null text counts as empty, which still has its end token;
equal rows are separate pieces; an empty table gives an empty result; extra
columns are kept out by name; ties in rank are broken by document and piece.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches, written
from sparkloom.llm.tokens import RANKS, VOCABULARY, encoder


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most; None is no limit. weights: of tokens,
    documents and attention cost in the choice of a bin."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"

    def even(self, counts: dict[int, int], least: int = 64) -> Capacities:
        """These capacities with the smallest limit on documents, doubled from
        ``least``, that makes the sequences of ``counts`` no more than no limit does."""
        free = replace(self, documents=None)
        aim, limit = sequences(plan(counts, free)), least
        while limit < self.tokens:
            held = replace(self, documents=limit)
            if sequences(plan(counts, held)) <= aim:
                return held
            limit *= 2
        return replace(self, documents=self.tokens)

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.int64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.int64)


def sequences(rows: list[tuple[int, int, int, int, int, int]]) -> int:
    """The number of bins of a plan."""
    return max((first + -(-(end - begin) // each) for _, begin, end, first, each, _ in rows), default=0)


def plan(counts: dict[int, int], capacities: Capacities = Capacities()) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first bin, pieces a bin, offset) rows that
    place ``counts[length]`` pieces of each length.

    Lengths go from long to short. Every class of equal open bins that has room
    under all capacities is a candidate; the residual vectors are taken as
    shares of the capacities. "norm" takes the class whose weighted residual is
    smallest after the piece is placed, "dot" that whose residual has the
    largest weighted dot product with the piece; ties go to the oldest bins. A
    chosen bin takes pieces of this length until it is full for them.
    """
    full = capacities.vector()
    weights = np.array(capacities.weights)
    residual = np.zeros((0, 3), dtype=np.int64)
    first, many = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows, bins = [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        need, left, rank = demand(length), counts[length], 0
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds a sequence")
        while left:
            fits = np.flatnonzero((residual >= need).all(axis=1))
            if len(fits):
                if capacities.rule == "dot":
                    score = -((residual[fits] / full) * (need / full) * weights).sum(axis=1)
                else:
                    score = ((((residual[fits] - need) / full) ** 2) * weights).sum(axis=1)
                at = int(fits[np.lexsort((first[fits], score))[0]])
            else:
                each = int((full // need).min())
                new = -(-left // each)
                residual, first, many = np.vstack([residual, full]), np.append(first, bins), np.append(many, new)
                bins += new
                at = len(first) - 1
            each = int((residual[at] // need).min())
            whole, rest = divmod(min(left, each * int(many[at])), each)
            used = []
            if whole:
                used.append((whole, each))
            if rest:
                used.append((1, rest))
            offset = int(full[0] - residual[at][0])
            start, of, spare = int(first[at]), residual[at].copy(), int(many[at])
            keep = np.arange(len(first)) != at
            residual, first, many = residual[keep], first[keep], many[keep]
            for n, k in used:
                rows.append((length, rank, rank + n * k, start, k, offset))
                rank, left, start, spare = rank + n * k, left - n * k, start + n, spare - n
                residual, first, many = np.vstack([residual, of - k * need]), np.append(first, start - n), np.append(many, n)
            if spare:
                residual, first, many = np.vstack([residual, of]), np.append(first, start), np.append(many, spare)
    return rows


def tokenised_pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 1024, end_id: int = 2, vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> DataFrame:
    """``key``, piece, start, length and ids (little-endian unsigned 32-bit) of
    every document's pieces: its ids and then ``end_id``, cut into pieces of
    ``size`` ids where longer, of which the first piece may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(vocabulary, ranks), struct.pack("<I", end_id)
        names = ["key", "piece", "start", "length", "ids"]
        for part, texts in text_batches(batches, "text"):
            rows, held = [[], [], [], [], []], 0
            for key, ids in zip(part.column(0).to_pylist(), own.ids(texts), strict=True):
                ids += end
                n = len(ids) // 4
                start, piece, stop = 0, 0, n % size or size
                while start < n:
                    for column, value in zip(rows, (key, piece, start, stop - start, ids[4 * start : 4 * stop]), strict=True):
                        column.append(value)
                    start, piece, stop = stop, piece + 1, stop + size
                held += len(ids)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types, strict=True)], names)
                    rows, held = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types, strict=True)], names)

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return rows.mapInArrow(cut, "key bigint, piece int, start bigint, length bigint, ids binary").withColumnRenamed("key", key)


#: Pieces of one length that a task ranks, about, and the bounds of the salts that this asks for.
RANKED, SALTS = 4_000_000, (64, 4096)


def assign_sequences(pieces: DataFrame, capacities: Capacities | None = None, key: str = "doc_id", salts: int | None = None) -> DataFrame:
    """``pieces`` (``key``, piece, length and any others) with sequence_id and offset.
    Without ``capacities`` those of 1024 tokens and an even limit on documents;
    without ``salts`` as many as the number of pieces asks for.

    ``pieces`` should be a written table, as it is read more than once.
    """
    spark = pieces.sparkSession
    salts = salts or min(max(SALTS[0], -(-pieces.count() // RANKED)), SALTS[1])
    ranked = pieces.withColumn("_salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)).cast("int"))
    # At most (lengths x salts) rows, whatever the corpus.
    found = ranked.groupBy("length", "_salt").count().toArrow()
    own, salt, n = (found[c].to_numpy() for c in ("length", "_salt", "count"))
    cells = np.zeros((int(own.max(initial=0)) + 1, salts), dtype=np.int64)
    cells[own, salt] = n
    totals = {k: int(x) for k, x in enumerate(cells.sum(axis=1)) if x}
    capacities = capacities or Capacities().even(totals)
    held = spark.sparkContext.broadcast((plan(totals, capacities), cells.cumsum(axis=1) - cells))
    window = Window.partitionBy("length", "_salt").orderBy(F.col(key).asc_nulls_first(), "piece")
    ranked = ranked.withColumn("_rank", F.row_number().over(window) - 1)
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, begins = held.value
        table = np.array(rows, dtype=np.int64).reshape(-1, 6)
        # Rows of one length follow each other in rank, so (length, rank) is ordered.
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        scale = np.int64(1) << 40
        keys = table[:, 0] * scale + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            salt = batch.column("_salt").to_numpy(zero_copy_only=False)
            rank = begins[length, salt] + batch.column("_rank").to_numpy(zero_copy_only=False)
            at = table[np.searchsorted(keys, length * scale + rank, side="right") - 1]
            bin_, slot = np.divmod(rank - at[:, 1], at[:, 4]) if len(at) else (rank, rank)
            out = [*(batch.column(x) for x in names), pa.array(at[:, 3] + bin_), pa.array(at[:, 5] + slot * length)]
            yield pa.RecordBatch.from_arrays(out, [*names, "sequence_id", "offset"])

    schema = f"{', '.join(f'`{x.name}` {x.dataType.simpleString()}' for x in pieces.schema)}, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)


def packed(docs: DataFrame, capacities: Capacities | None = None, text: str = "text", key: str = "doc_id", end_id: int = 2, vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> DataFrame:
    """Tokenise and pack: ``key``, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are encoded once; the pieces are written without their ids, which
    tokenised_pieces() gives where they are wanted.
    """
    pieces = tokenised_pieces(docs, text, key, (capacities or Capacities()).tokens, end_id, vocabulary, ranks)
    digests = pieces.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return assign_sequences(written(digests, "pieces"), capacities, key)
