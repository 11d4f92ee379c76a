"""Quality rules by tokeniser fertility.

A public vocabulary measures each text: characters per token, the share of
byte-fallback tokens and the entropy of its tokens. A text outside the bands of
its language is rejected; languages without bands of their own go by the script
that most of their letters are of. Two base rules come first: at least 20 words,
and at most 30 % of the words in windows of eight words that occur twice.

Words are encoded one by one, so a word costs its encoding once per task.

Defined cases: a null text has no words and fails the base rules; a null language
goes by script; every row gives one row, repeated rows and null ids too; an empty
table gives an empty result; other columns of the input are left out.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.tables import table

VOCABULARY = "piece_bpe_32k.model"
# Fixed values of this vocabulary: ids of the 256 byte-fallback tokens.
FIRST_BYTE, LAST_BYTE = 3, 258
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
# A worker numbers words anew when it has this many; it still knows the tokens of those.
MAX_WORDS = 300_000


class Band(NamedTuple):
    """Allowed characters per token, byte-fallback share, and entropy in bits per token."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


BANDS = {
    "en": Band(1.7, 6.0, 0.05, 4.5),
    "de": Band(1.9, 6.0, 0.05, 4.5),
    "fr": Band(1.6, 6.0, 0.05, 4.5),
    "es": Band(1.7, 6.0, 0.05, 4.5),
}
# Scripts by their first and last code point; other letters count as "other".
SCRIPTS = {
    "latin": (0x41, 0x24F),
    "greek": (0x370, 0x3FF),
    "cyrillic": (0x400, 0x52F),
    "arabic": (0x600, 0x6FF),
    "devanagari": (0x900, 0x97F),
    "cjk": (0x3040, 0x9FFF),
    "hangul": (0xAC00, 0xD7A3),
}
SCRIPT_BANDS = {
    "latin": Band(1.5, 7.0, 0.05, 4.0),
    "greek": Band(0.7, 4.0, 0.20, 3.0),
    "cyrillic": Band(1.0, 5.0, 0.10, 3.0),
    "arabic": Band(0.5, 4.0, 0.20, 3.0),
    "devanagari": Band(0.3, 4.0, 0.60, 3.0),
    "cjk": Band(0.3, 2.0, 0.70, 3.0),
    "hangul": Band(0.3, 2.0, 0.80, 3.0),
    "other": Band(0.2, 7.0, 1.0, 2.0),
}


class Words:
    """Numbers words and encodes them, each one once as long as it is remembered."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.encoder = SentencePieceProcessor(model_file=path)
        self.numbers: dict[bytes, int] = {}
        self.tokens: list[bytes] = []
        self.older: tuple[dict[bytes, int], list[bytes]] = ({}, [])

    def learn(self, texts: list[list[bytes]]) -> None:
        if len(self.tokens) > MAX_WORDS:
            self.older = self.numbers, self.tokens
            self.numbers, self.tokens = {}, []
        missing = set().union(*texts) - self.numbers.keys()
        numbers, tokens = self.older
        known = list(missing & numbers.keys())
        new = list(missing.difference(known))
        ids = self.encoder.encode([w.decode("utf-8", "replace") for w in new], num_threads=1)
        first = len(self.tokens)
        self.numbers.update(zip(known + new, range(first, first + len(missing)), strict=True))
        self.tokens.extend(tokens[numbers[w]] for w in known)
        self.tokens.extend(array("H", i).tobytes() for i in ids)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers, and their token ids."""
        numbers = list(map(self.numbers.__getitem__, words))
        ids = b"".join(map(self.tokens.__getitem__, numbers))
        return np.array(numbers, np.int64), np.frombuffer(ids, np.uint16)


@functools.cache
def words_of(path: str) -> Words:
    """One per Python worker, so that later tasks of the worker know the words too."""
    return Words(path)


def count_of(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(names: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more.

    ``names`` are numbers, equal for equal words. Windows are named exactly: equal
    pairs get equal numbers, then pairs of pairs.
    """
    n = len(names)
    if n <= window:
        return 0
    above = int(names.max()) + 1
    width = 1
    while width < window:
        pairs = names[:-width] * above + names[width:]
        _, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width, above = 2 * width, n
        if counts.max() == 1:
            return 0
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(counts[names] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    repeats = 0
    for line in data.split(b"\n"):
        if line in seen:
            repeats += bool(line.strip(BLANKS))
        seen.add(line)
    return repeats


def script_of(text: str) -> str:
    """The script of most letters; Latin for a text without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = int((points >= 0x41).sum())
    counts = {
        name: int(((points >= low) & (points <= high)).sum()) for name, (low, high) in SCRIPTS.items()
    }
    counts["other"] = letters - sum(counts.values())
    return max(counts, key=counts.get)


class Measure(NamedTuple):
    chars_per_token: float
    byte_share: float
    entropy: float


def measure(chars: int, ids: np.ndarray) -> Measure:
    """Of no tokens all are 0."""
    if not len(ids):
        return Measure(0.0, 0.0, 0.0)
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    in_bytes = (ids >= FIRST_BYTE) & (ids <= LAST_BYTE)
    return Measure(chars / len(ids), float(in_bytes.mean()), float(-(counts * np.log2(counts)).sum()))


def inside(m: Measure, band: Band, tokens: int) -> bool:
    """Entropy cannot exceed that of all different tokens, so short texts need less."""
    least = min(band.least_entropy, 0.6 * np.log2(max(tokens, 2)))
    return (
        band.least_chars <= m.chars_per_token <= band.most_chars
        and m.byte_share <= band.most_bytes
        and m.entropy >= least
    )


SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, "
    "chars_per_token double, byte_share double, entropy double, band string"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def rules(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    vocabulary: str | None = None,
    bands: dict[str, Band] = BANDS,
    script_bands: dict[str, Band] = SCRIPT_BANDS,
) -> DataFrame:
    """Counts, measures and verdict of every text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def judge(encoder: Words, content: str, language: str | None, words: list[bytes]) -> tuple:
        data = content.encode("utf-8", "surrogatepass")
        chars = len(content) - count_of(data, BLANKS)
        numbers, ids = encoder.encode(words)
        repeats = repeated_words(numbers)
        failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
        name = language if language in bands else script_of(content)
        band = bands[name] if language in bands else script_bands[name]
        m = measure(chars, ids)
        kept = not failed and inside(m, band, len(ids))
        return (
            len(words), chars, count_of(data, SYMBOLS), repeated_lines(data), repeats,
            failed, kept, *m, name,
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = words_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
                langs = part.column(2).to_pylist()
                encoder.learn(words)
                rows = [judge(encoder, *row) for row in zip(texts, langs, words, strict=True)]
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *NAMES])

    rows = docs.select(id, text, lang)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, {SCHEMA}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: fertility rules over every document."""
    return rules(table(spark, sf_dir, "documents"))
