"""Packing documents into token sequences in the order of a space-filling curve.

A document's token counts are hashed to a short vector, which is projected to few dimensions;
the place of that point on a Hilbert curve is the document's key. Rows are range-sorted by key,
so neighbours on the curve, which are documents of like words, follow each other and share
sequences. A token's place in the whole order is its place in its partition plus the tokens of
the partitions before; sequences are equal cuts of that order, so none but the last is padded.
The tokens left over are cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial
from itertools import repeat
from statistics import NormalDist
from string import ascii_letters, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from fieldgauge.llm.batches import parts
from fieldgauge.llm.tables import stored
from fieldgauge.session import shuffle_partitions

SEQUENCE, EOS = 4096, 2
HASHED, DIMENSIONS, BITS, SEED = 512, 4, 8, 12
FIXED = 1 << 20  # projections are whole numbers of this part, so that their sums do not depend on order
#: Token ids of a longer document are kept in rows of so many.
ROW_TOKENS = 1 << 14
#: Words up to this many characters are remembered, up to so many tokens a worker process.
WORD_CHARS, REMEMBERED_TOKENS = 64, 4_000_000
#: New words are encoded so many to a text, so many texts a call.
JOINED, BATCH = 200, 50
MARKS = ".,;:!?"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of texts by a tokenizer that neither joins nor looks over white space.

    Each different word between blanks is encoded once, many to a text, and told apart by
    the offsets of their tokens; a text's ids are those of its words. ``whole`` encodes texts
    uncut, for tokenizers that treat blanks as content.
    """

    def __init__(self, path: str, whole: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the unit of parallel work
        from tokenizers import Tokenizer

        self.tokenizer, self.whole = Tokenizer.from_file(path), whole
        self._forget()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.folds, self.parts_marks = self._folds(), self._parts_marks()

    def _folds(self) -> bool:
        """Whether A to Z count as a to z, so that words may be lower-cased before they are looked up."""
        normal = self.tokenizer.normalizer
        return normal is not None and all(normal.normalize_str(c) == c.lower() for c in ascii_uppercase)

    def _parts_marks(self) -> bool:
        """Whether a mark after a letter is always a word of its own, so that a blank between them changes nothing."""
        cut = self.tokenizer.pre_tokenizer
        if cut is None or any(re.search(f"[A-Za-z][{MARKS}]", t) for t in self.added):
            return False
        return all(cut.pre_tokenize_str(f"{c}{m}")[0][1] == (0, 1) for c in ascii_letters for m in MARKS)

    def _words(self, texts: pa.Array) -> tuple[pa.Array, pa.DictionaryArray]:
        """Words of each text, and all of them coded; fewer distinct ones where the tokenizer sees no difference."""
        if self.parts_marks:
            texts = pc.replace_substring_regex(texts, f"([A-Za-z])([{MARKS}])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        if self.folds:
            lowered = pc.ascii_lower(flat).dictionary_encode()
            if not any(pc.any(pc.match_substring(lowered.dictionary, t.lower())).as_py() for t in self.added):
                return split, lowered
        return split, flat.dictionary_encode()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.size = 0
        self.ids, self.first, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), JOINED * BATCH):
            some = [words[i : i + JOINED] for i in range(at, min(at + JOINED * BATCH, len(words)), JOINED)]
            for held, e in zip(some, self.tokenizer.encode_batch([" ".join(one) for one in some], add_special_tokens=False), strict=True):
                lengths = np.fromiter(map(len, held), np.int64, len(held)) + 1
                ids = np.array(e.ids, dtype=np.uint32)
                starts = [start for start, _ in e.offsets]
                word = np.searchsorted(np.cumsum(lengths) - lengths, starts, side="right") - 1
                self._remember(held, np.bincount(word, minlength=len(held)), ids)
        count = np.concatenate([self.count[:0], *[c for c, _ in self.new]])
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, *[i for _, i in self.new]])
        self.new = []

    def _remember(self, words: list[str], count: np.ndarray, ids: np.ndarray) -> None:
        self.place.update(zip(words, range(self.size, self.size + len(words)), strict=True))
        self.size += len(words)
        self.new.append((count, ids))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        if self.whole or not len(texts):
            return [np.array(ids, dtype=np.uint32) for ids in self._encode(texts.to_pylist())]
        split, coded = self._words(texts)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.ids) > REMEMBERED_TOKENS:
            self._forget()
        known = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(known < 0)
        known[new] = self.size + np.arange(len(new))
        self._learn([words[i] for i in new.tolist()])
        at = known[coded.indices.to_numpy()]
        counts = self.count[at]
        ends = np.cumsum(counts)
        places = np.repeat(self.first[at] - ends + counts, counts)
        places += np.arange(len(places))
        ids = self.ids[places]
        for word in coded.dictionary.filter(pc.greater(pc.utf8_length(coded.dictionary), WORD_CHARS)).to_pylist():
            del self.place[word]  # long words are rare and would fill the memory
        bounds = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.split(ids, bounds[:-1])


def kept_encoder(path: str, whole: bool) -> WordEncoder:
    """The encoder of this worker process: words learnt in one task serve the next."""
    import tokenizers

    kept = vars(tokenizers).setdefault("__kept_encoders__", {})
    if (path, whole) not in kept:
        kept[path, whole] = WordEncoder(path, whole)
    return kept[path, whole]


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((HASHED, DIMENSIONS))


def project(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Whole-number coordinates of a document: log counts of hashed ids at unit length, projected."""
    hashed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASHED.bit_length() + 1)
    vector = np.log1p(np.bincount(hashed.astype(np.int64), minlength=HASHED))
    length = np.sqrt(vector @ vector)
    return np.rint((vector @ matrix) / (length or 1.0) * FIXED).astype(np.int64)


COORDINATES = [f"p{d}" for d in range(DIMENSIONS)]


def tokenized(documents: DataFrame, path: str | None = None, eos: int = EOS, whole: bool = False) -> DataFrame:
    """(doc_id, place, start, doc_tokens, tokens, ids, p0...): token ids in rows of at most ``ROW_TOKENS``.

    ``ids`` are little-endian, of 2 bytes where the vocabulary allows, else of 4.
    """
    source = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    numbers = [StructField(n, LongType()) for n in ("place", "start", "doc_tokens", "tokens")]
    schema = StructType([source.schema["doc_id"], *numbers, StructField("ids", BinaryType()), *[StructField(c, LongType()) for c in COORDINATES]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matrix = kept_encoder(path or tokenizer_path(), whole), _projection()
        kind = _width(max(encoder.tokenizer.get_vocab_size(), eos + 1))
        for batch in parts(batches):
            made: list[list] = [[] for _ in schema.fields[1:]]
            rows: list[int] = []
            for i, ids in enumerate(encoder(batch.column("text"))):
                ids = np.append(ids, np.uint32(eos))
                point, place = project(ids, matrix).tolist(), batch.column("place")[i].as_py()
                for start in range(0, len(ids), ROW_TOKENS):
                    cut = ids[start : start + ROW_TOKENS]
                    rows.append(i)
                    for into, value in zip(made, [place, start, len(ids), len(cut), cut.astype(kind).tobytes(), *point], strict=True):
                        into.append(value)
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.binary() if f.name == "ids" else pa.int64()) for c, f in zip(made, schema.fields[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(encode, schema)


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of whole-number points (rows) of ``bits`` bits a dimension.

    From the highest bit down, the part of the cube a point lies in turns or mirrors the axes of
    what is inside; the Gray code of the parts, undone, gives the digits of the place.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            high = (x[d] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[dims - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> bit) & 1)
    return key


def curve_key(rows: DataFrame) -> Column:
    """Hilbert key of the coordinates, each spread evenly by its mean and deviation over all documents."""
    first = rows.filter(F.col("start") == 0)
    sums = [f.alias(f"{k}_{c}") for c in COORDINATES for k, f in (("s", F.sum(c)), ("q", F.sum(F.col(c).cast("decimal(38,0)") * F.col(c))))]
    row = first.agg(F.count("*").alias("n"), *sums).first()
    n = max(1, row["n"])
    scale = []
    for c in COORDINATES:
        mean = (row[f"s_{c}"] or 0) / n
        scale.append((mean, max(float(row[f"q_{c}"] or 0) / n - mean * mean, 1.0) ** 0.5))
    cuts = np.array([NormalDist().inv_cdf(i / (1 << BITS)) for i in range(1, 1 << BITS)])

    def key(*columns: pd.Series) -> pd.Series:
        cells = [np.searchsorted(cuts, (c.to_numpy() - mean) / deviation) for c, (mean, deviation) in zip(columns, scale, strict=True)]
        return pd.Series(hilbert(np.stack(cells, axis=1), BITS))

    return F.pandas_udf(key, "long")(*[F.col(c) for c in COORDINATES])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the tokens before each row in it."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        tokens = batch.column("tokens").to_numpy()
        earlier = before + np.cumsum(tokens) - tokens
        before += int(tokens.sum())
        columns = [*batch.columns, pa.array(np.full(len(tokens), part, dtype=np.int64)), pa.array(earlier)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "earlier"])


def _cut(batches: Iterator[pa.RecordBatch], length: int, total: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Pieces of each row, cut where sequences end."""
    whole = total // length * length
    ends, left = [whole], total - whole
    while left:  # powers of two, largest first
        ends.append(ends[-1] + (1 << (left.bit_length() - 1)))
        left = total - ends[-1]
    for batch in batches:
        names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        made: dict[str, list] = {n: [] for n in names}
        rows: list[int] = []
        columns = [batch.column(c).to_pylist() for c in ("start", "doc_tokens", "ids", "before")]
        for i, (start, doc_tokens, data, at) in enumerate(zip(*columns, strict=True)):
            ids, done = np.frombuffer(data, dtype=kind).astype("<u4"), 0
            while done < len(ids):
                if at < whole:
                    sequence, first, end = at // length, at // length * length, at // length * length + length
                else:
                    k = bisect_right(ends, at)
                    sequence, first, end = whole // length + k - 1, ends[k - 1], ends[k]
                n = min(len(ids) - done, end - at)
                rows.append(i)
                for name, value in zip(names, (start + done, n, ids[done : done + n].tobytes(), doc_tokens, sequence, at - first), strict=True):
                    made[name].append(value)
                done, at = done + n, at + n
        out = [pa.array(made[n], pa.binary() if n == "ids" else pa.int64()) for n in names]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *out], names=["doc_id", *names])


def pack(documents: DataFrame, path: str | None = None, length: int = SEQUENCE, eos: int = EOS, whole_texts: bool = False) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all sequences.

    ``ids`` holds a piece's token ids as little-endian unsigned 32-bit numbers; a document's ids
    end with ``eos``. Sequences hold exactly ``length`` tokens, those after them powers of two.
    ``path`` is the vocabulary file on every executor (default: the public one of 49,408 words,
    where it is installed). A tokenizer for which blanks count needs ``whole_texts``.

    A NULL or empty text is its ``eos`` alone; NULL ids and repeated rows are packed like any
    other; equal texts have one key and are ordered as they were read; an empty table gives no
    rows; other columns are ignored.
    """
    spark = documents.sparkSession
    rows = stored(tokenized(documents, path, eos, whole_texts), "tokens", "zstd")
    order = ["key", "place", "start"]
    keyed = rows.withColumn("key", curve_key(rows)).select("doc_id", "start", "doc_tokens", "tokens", "ids", "key", "place")
    ranged = keyed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).drop("key", "place")
    schema = StructType([*ranged.schema.fields, StructField("part", LongType()), StructField("earlier", LongType())])
    ordered = stored(ranged.mapInArrow(_numbered, schema), "ordered", "zstd")
    totals = sorted(tuple(r) for r in ordered.groupBy("part").agg(F.sum("tokens")).collect())  # a row for each partition
    total, offsets = 0, []
    for part, tokens in totals:
        offsets.append((part, total))
        total += tokens
    offsets = F.broadcast(spark.createDataFrame(offsets, "part long, __offset long"))
    placed = ordered.join(offsets, "part").select("doc_id", "start", "doc_tokens", "ids", (F.col("earlier") + F.col("__offset")).alias("before"))
    numbers = [StructField(n, LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
    out = StructType([placed.schema["doc_id"], StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()), *numbers])
    kind = _width(max(_vocabulary(path), eos + 1))
    return placed.mapInArrow(partial(_cut, length=length, total=total, kind=kind), out)


def _vocabulary(path: str | None) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or tokenizer_path()).get_vocab_size()
