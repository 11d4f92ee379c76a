"""Token ids in files: a wavelet matrix for every shard.

Documents in ascending order of their id are cut into shards of bounded size. A
shard's ids, numbered by the shard's own sorted vocabulary, form a wavelet matrix:
one bit plane for each binary digit, where each plane is sorted stably by the digit
of the plane above. Planes, vocabulary and document lengths of a shard are one row
of a Parquet file, compressed; a partition writes one file. Rank samples are built
on loading, so access, counting and lookup need no decoding.

File format, a row per shard: part and shard (files in the order of ids, shards
within a file), n_tokens, doc_ids (as given), lengths (uint32), vocabulary (sorted
uint32), planes (highest digit first, each padded to whole bytes), zeros (of each
plane, uint32). All numbers are little-endian.

Defined cases: a null text is an empty one, which has the end id alone; null ids
come first; rows of equal id follow each other by a hash of the text, equal rows tie,
and both may fill several files; an
empty table gives an empty result; other columns of the input are left out.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import table
from tickloom.operators.ranges import size_of
from tickloom.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
END = 0
# A shard is closed once it has this many tokens; a document is never divided.
SHARD_TOKENS = 1 << 21
# Bytes of input for one file.
FILE_BYTES = 1 << 24
# Pieces that a worker remembers; beyond, the half that is unused the longest goes.
MAX_PIECES = 1_500_000
# Letters, numbers and blanks up to U+00FF, as the vocabulary's splitter has them.
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\\t-\\r \x85\xa0"
PIECE = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
WIDE = re.compile("[^\x00-\xff]")


def byte_letters() -> dict[int, str]:
    """The vocabulary's letter for every byte: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Memory(dict):
    """What was used lately: beyond ``most`` entries those unused the longest go, half of all.

    Reading a key that it does not hold makes and keeps its value.
    """

    def __init__(self, most: int, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.half, self.older, self.make = most // 2, {}, make

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of texts as little-endian uint16.

    The vocabulary never joins two pieces of its splitter, so a piece is encoded
    once and remembered. Texts with characters above U+00FF, or with a special token's
    brackets, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.pieces = Memory(MAX_PIECES, self._piece)

    def _whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece; the model is asked without splitting it again."""
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        if not text.isascii() and WIDE.search(text) or "<|" in text:
            return self._whole(text)
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text)))


@functools.cache
def encoder_of(path: str) -> Encoder:
    """One per Python worker, so that later tasks of the worker know the pieces too."""
    return Encoder(path)


class WaveletMatrix:
    """Succinct sequence of ids with access, rank and select."""

    # Set bits are counted up to every so many bytes.
    SAMPLE = 64

    def __init__(self, n: int, vocabulary: np.ndarray, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.vocabulary, self.planes, self.zeros = n, vocabulary, planes, zeros
        self._samples: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        used = np.zeros(int(ids.max(initial=0)) + 1, bool)
        used[ids] = True
        vocabulary = np.flatnonzero(used).astype(np.uint32)
        numbers = np.zeros(len(used), np.uint16 if len(used) <= 1 << 16 else np.uint32)
        numbers[vocabulary] = np.arange(len(vocabulary))
        rest, planes, zeros = numbers[ids], [], []
        for digit in reversed(range(max(1, (len(vocabulary) - 1).bit_length()))):
            bits = (rest >> digit & 1).astype(bool)
            planes.append(np.packbits(bits))
            # Positions of random bits are found faster than a mask is applied.
            low = rest.take(np.flatnonzero(~bits))
            zeros.append(len(low))
            rest = np.concatenate([low, rest.take(np.flatnonzero(bits))])
        return cls(len(ids), vocabulary, planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids in order, plane by plane from the lowest."""
        digits = len(self.planes)
        rest = np.zeros(self.n, np.uint16 if len(self.vocabulary) <= 1 << 16 else np.uint32)
        for digit, (plane, zero) in enumerate(
            zip(reversed(self.planes), reversed(self.zeros), strict=True)
        ):
            bits = np.unpackbits(plane, count=self.n).astype(bool)
            before = np.empty_like(rest)
            before[np.flatnonzero(~bits)] = rest[:zero]
            before[np.flatnonzero(bits)] = rest[zero:] | rest.dtype.type(1 << digit)
            rest = before
        return self.vocabulary[rest]

    def _ones(self, level: int, upto: int) -> int:
        """Set bits of a plane before a position."""
        if self._samples is None:
            self._samples = []
            for plane in self.planes:
                counts = np.bitwise_count(plane)
                sums = np.add.reduceat(counts, np.arange(0, len(plane), self.SAMPLE), dtype=np.int64)
                self._samples.append(np.concatenate([[0], np.cumsum(sums)]))
        byte, bit = divmod(upto, 8)
        block = byte // self.SAMPLE
        plane = self.planes[level]
        total = int(self._samples[level][block])
        total += int(np.bitwise_count(plane[block * self.SAMPLE : byte]).sum(dtype=np.int64))
        return total + (int(plane[byte]) >> (8 - bit)).bit_count() if bit else total

    def access(self, at: int) -> int:
        """The id at a position."""
        number = 0
        for level, zero in enumerate(self.zeros):
            bit = int(self.planes[level][at >> 3]) >> (7 - (at & 7)) & 1
            ones = self._ones(level, at)
            number = number << 1 | bit
            at = zero + ones if bit else at - ones
        return int(self.vocabulary[number])

    def _number(self, token: int) -> int | None:
        place = int(np.searchsorted(self.vocabulary, token))
        known = place < len(self.vocabulary) and self.vocabulary[place] == token
        return place if known else None

    def _narrow(self, number: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences between two positions lie below the last plane."""
        digits = len(self.planes)
        for level, zero in enumerate(self.zeros):
            a, b = self._ones(level, start), self._ones(level, end)
            if number >> (digits - 1 - level) & 1:
                start, end = zero + a, zero + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id between two positions."""
        number = self._number(token)
        if number is None:
            return 0
        end = self.n if end is None else min(end, self.n)
        low, high = self._narrow(number, min(start, end), end)
        return high - low

    def select(self, token: int, nth: int) -> int | None:
        """Position of the nth occurrence (from 0) of an id."""
        number = self._number(token)
        if number is None or not 0 <= nth < self.count(token):
            return None
        at = self._narrow(number, 0, 0)[0] + nth
        digits = len(self.planes)
        for level in reversed(range(digits)):
            bit = number >> (digits - 1 - level) & 1
            at = self._position(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _position(self, level: int, bit: int, nth: int) -> int:
        """Position of the nth set (or unset) bit of a plane, by binary search on rank."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > nth:
                high = middle
            else:
                low = middle + 1
        return low

    def occurrences(self, token: int) -> Iterator[int]:
        """All positions of an id, ascending."""
        return (self.select(token, k) for k in range(self.count(token)))


def to_row(part: int, shard: int, doc_ids: list, ids: list[bytes]) -> dict:
    matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), np.uint16))
    return {
        "part": part,
        "shard": shard,
        "n_tokens": matrix.n,
        "doc_ids": doc_ids,
        "lengths": np.array([len(x) // 2 for x in ids], "<u4").tobytes(),
        "vocabulary": matrix.vocabulary.astype("<u4").tobytes(),
        "planes": b"".join(p.tobytes() for p in matrix.planes),
        "zeros": np.array(matrix.zeros, "<u4").tobytes(),
    }


def from_row(row: dict) -> tuple[np.ndarray, WaveletMatrix]:
    """Document lengths and the matrix of a shard."""
    planes = np.frombuffer(row["planes"], np.uint8)
    zeros = np.frombuffer(row["zeros"], "<u4").tolist()
    matrix = WaveletMatrix(
        row["n_tokens"],
        np.frombuffer(row["vocabulary"], "<u4"),
        list(planes.reshape(len(zeros), -1)),
        zeros,
    )
    return np.frombuffer(row["lengths"], "<u4"), matrix


def shard_schema(id_type: str) -> str:
    return (
        f"part int, shard int, n_tokens bigint, doc_ids array<{id_type}>, lengths binary, "
        "vocabulary binary, planes binary, zeros binary"
    )


def write_shards(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode all texts and write the files, in ascending order of the ids."""
    source = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # Ranges of ids, and in them equal ids by text: the files follow each other in this order.
    files = max(docs.sparkSession.sparkContext.defaultParallelism, size_of(docs) // FILE_BYTES)
    # An id with very many rows fills several files, and so do equal rows.
    rows = rows.withColumns({"name": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), "name", "nth"]
    ranges = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("name", "nth")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = encoder_of(source), TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0
        kind = None

        def closed() -> pa.RecordBatch:
            row = to_row(part, shard, doc_ids, ids)
            types = {"part": pa.int32(), "shard": pa.int32(), "n_tokens": pa.int64()}
            types["doc_ids"] = pa.list_(kind)
            columns = {k: pa.array([v], types.get(k, pa.binary())) for k, v in row.items()}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                texts = piece.column("text").to_pylist()
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts, strict=True):
                    doc_ids.append(doc_id)
                    ids.append(encoder.encode(text) + array("H", [END]).tobytes())
                    size += len(ids[-1]) // 2
                    if size >= shard_tokens:
                        yield closed()
                        doc_ids, ids, size, shard = [], [], 0, shard + 1
        if ids:
            yield closed()

    shards = ranges.mapInArrow(task, shard_schema(id_type))
    shards.write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(shard_schema(id_type)).parquet(path)


def decoded(shards: DataFrame, id_type: str = "bigint", digest: bool = False) -> DataFrame:
    """Documents of the files: part, shard, doc_id, offset, n_tokens, ids (uint32 bytes).

    With ``digest`` the ids stay in their task and ids_crc32 tells their checksum.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                lengths, matrix = from_row(row)
                ids = matrix.decode().astype("<u4", copy=False)
                starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                data = (ids[a:b].tobytes() for a, b in zip(starts, starts[1:], strict=False))
                if digest:
                    last = pa.array([zlib.crc32(d) for d in data], pa.int64())
                else:
                    last = pa.array(list(data), pa.binary())
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], kind),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(lengths.astype(np.int64), pa.int64()),
                        last,
                    ],
                    names=["part", "shard", "doc_id", "offset", "n_tokens", name],
                )

    name, content = ("ids_crc32", "bigint") if digest else ("ids", "binary")
    schema = (
        f"part int, shard int, doc_id {id_type}, offset bigint, n_tokens bigint, {name} {content}"
    )
    return shards.mapInArrow(task, schema)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard: part, shard, before. One row per shard, of bounded tokens each."""
    upto = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(upto), F.lit(0)).alias("before")
    return shards.select("part", "shard", "n_tokens").select("part", "shard", before)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all documents written to shards and read back from them."""
    path = scratch_dir(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), path)
    shards = read_shards(spark, path)
    rows = decoded(shards, digest=True)
    return rows.join(shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
