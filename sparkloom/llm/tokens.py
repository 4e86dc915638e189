"""Token counts and ids by a public byte-level BPE vocabulary.

The pre-tokenizer never joins text across a single space that stands between
two non-space characters, so a text may be cut before each such space and the
pieces encoded apart: the concatenated ids equal those of the whole text. That
gives safe boundaries for long texts, and lets the ids of a piece be kept, as
most pieces are words that come again and again. The pieces of a batch of texts
that were not seen yet are encoded in one batch call of the tokenizers library.

Defined results: a null text counts as empty (no tokens); special strings
inside a text become their special ids, which is the library's default; extra
columns are not read; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import os
import re
import struct
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: A single space between two non-space characters.
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Characters of a text that are cut into pieces at once.
PART = 1 << 20
#: Characters of the runs in which unseen words are encoded.
RUN = 1 << 12
#: Beyond Latin letters, or a special string's beginning: left to the tokenizers library.
RARE = re.compile("[^\x00-\u024f]|<\\|")
#: The space in the vocabulary's alphabet.
SPACE = "\u0120"


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut at safe boundaries."""
    at = 0
    while len(text) - at > size and (cut := SAFE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    """Ids by batches of texts. ``most`` bounds the pieces that are remembered
    from batch to batch, and so the memory. With ``ranks``, the same vocabulary
    as merge ranks, runs of unseen Latin words go through the rank-based encoder,
    which takes a third of the time and gives the same ids."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str | None = None, most: int = 400_000):
        # A worker is one core's share; the library's threads would take others'.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast: Callable[[str], list[int]] | None = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self.most = most
        vocabulary_size = self.library.get_vocab_size(with_added_tokens=True)
        #: Whether an id's text holds a space.
        self.spaced = np.array([SPACE in (self.library.id_to_token(i) or "") for i in range(vocabulary_size)])
        #: Ids of words by the word, without the space before it.
        self.known: dict[str, bytes] = {}

    def encoded(self, pieces: list[str]) -> list[bytes]:
        """The library's ids of each piece, as little-endian unsigned 32-bit numbers."""
        made = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in made]

    def run_ids(self, runs: list[str]) -> Iterator[list[int]]:
        """The ids of each run of words."""
        plain = [bool(self.fast) and not RARE.search(x) for x in runs]
        others = iter(self.library.encode_batch_fast([x for x, p in zip(runs, plain, strict=True) if not p], add_special_tokens=False))
        for x, p in zip(runs, plain, strict=True):
            yield self.fast(x) if p else next(others).ids

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words, each with the space before it.

        Words are encoded in runs of many, balanced by length. Only a word's
        first id holds a space, so a run's ids fall apart at these. Special
        strings may take the space before them and are encoded alone.
        """
        groups: dict[str, list[str]] = {"alone": [], "plain": [], "rare": []}
        for w in words:
            groups["alone" if len(w) > RUN or "<|" in w else "rare" if self.fast and RARE.search(w) else "plain"].append(w)
        alone = groups.pop("alone")
        self.known.update(zip(alone, self.encoded([" " + w for w in alone]), strict=True))
        runs: list[list[str]] = []
        for group in groups.values():
            ends = np.cumsum([len(w) + 1 for w in group])
            cuts = np.flatnonzero(np.diff(ends // RUN)) + 1
            runs += [group[a:b] for a, b in pairwise([0, *cuts.tolist(), len(group)]) if a < b]
        for run, made in zip(runs, self.run_ids([" " + " ".join(run) for run in runs]), strict=True):
            ids = np.array(made, dtype="<u4")
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) != len(run):
                self.known.update(zip(run, self.encoded([" " + w for w in run]), strict=True))
                continue
            data, cuts = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
            self.known.update(zip(run, (data[a:b] for a, b in pairwise(cuts)), strict=True))

    def _cut(self, text: str) -> tuple[str, list[str], str | None]:
        """The first piece; the words that follow, each after a space; and a last
        word that ends in white space, if there is one. For texts with runs of
        white space, which stay whole."""
        first, *words = SAFE.split(text)
        if words and words[-1][-1].isspace():
            return first, words[:-1], words[-1]
        return first, words, None

    def pieces(self, texts: list[str]) -> list[list[bytes]]:
        """The ids of each text's pieces, in order."""
        if len(self.known) > self.most:
            self.known.clear()
        get, cuts, fresh = self.known.get, [], set()
        for text in texts:
            first, *words = text.split(" ")
            found = list(map(get, words))
            new = {w for w, x in zip(words, found, strict=True) if x is None}
            last = None
            # Remembered words have no white space at their edges.
            if first[-1:].isspace() or not first and words or not all(w and not w[0].isspace() and not w[-1].isspace() for w in new):
                first, words, last = self._cut(text)
                found = list(map(get, words))
                new = {w for w, x in zip(words, found, strict=True) if x is None}
            fresh |= new
            cuts.append((first, words, found, bool(new), last))
        self.learn(list(fresh))
        own = self.encoded([*(x[0] for x in cuts), *(" " + x[4] for x in cuts if x[4] is not None)])
        lasts, known, out = iter(own[len(cuts) :]), self.known.__getitem__, []
        for begin, (_, words, found, new, last) in zip(own, cuts, strict=False):
            out.append([begin, *(map(known, words) if new else found), *([] if last is None else [next(lasts)])])
        return out

    def batch(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        """pieces() of whole texts, of which long ones are read in parts."""
        short = [i for i, x in enumerate(texts) if x and len(x) <= PART]
        done = dict(zip(short, self.pieces([texts[i] for i in short]), strict=True)) if short else {}
        for i, text in enumerate(texts):
            yield done.pop(i) if i in done else [b"".join(self.pieces([p])[0]) for p in parts(text)] if text else []

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        return (b"".join(x) for x in self.batch(texts))

    def counts(self, texts: list[str | None]) -> list[int]:
        """The number of ids of each text."""
        return [sum(map(len, x)) // 4 for x in self.batch(texts)]


_encoders: dict[tuple, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str | None = None) -> Encoder:
    """The worker process's encoder; its remembered pieces serve all its tasks."""
    if (vocabulary, ranks) not in _encoders:
        _encoders[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _encoders[vocabulary, ranks]


def token_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY, batch_bytes: int = 1 << 20) -> DataFrame:
    """``key``, n_bytes and n_tokens of every whole text.

    Only lengths leave the Arrow function; its batches hold about
    ``batch_bytes`` of text, and long texts are cut at safe boundaries.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for part, texts in text_batches(batches, "text", batch_bytes):
            sizes = pa.compute.fill_null(pa.compute.binary_length(part.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(own.counts(texts), pa.int64())], ["key", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(count, f"key {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("key", key)
