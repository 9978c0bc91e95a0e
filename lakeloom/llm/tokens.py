"""Token ids and counts of whole texts with a byte-level BPE file of the tokenizers library.

A text is cut where its pre-tokenizer starts anew whatever stands before: after white space or a run of one
kind, as given by ``CUT``. The pieces between such boundaries repeat across texts, so the ids or lengths of
pieces met before are kept, and added up or joined. Nothing of a text is left out.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from struct import pack

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import text_or_empty

FILE = "byte_bpe_50k.json"
BATCH_BYTES = 1 << 20   # text that is cut and encoded together
MEMO_BYTES = 96 << 20   # pieces and ids that a Python worker keeps
MET = 1 << 23           # hashes of pieces met
MEMO_PIECES = 1 << 20   # pieces and lengths that a task keeps

# White space as the pre-tokenizer sees it: Python's, without the four separators U+001C to U+001F.
_SPACE = r"[^\S\x1c-\x1f]"
_INK = r"[\S\x1c-\x1f]"
_LETTERS = r"A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r".,;:!?*#$%&|()"
CUT = re.compile(
    rf" ?[{_LETTERS}]+(?=[{_MARKS}]|{_SPACE}|\Z)"          # a word up to a mark, white space or the end
    rf"| ?[{_MARKS}]+(?=[{_LETTERS}0-9]|{_SPACE}|\Z)"      # marks up to a word, white space or the end
    rf"|{_SPACE}*{_INK}+|{_SPACE}+")                       # anything else up to white space


SINGLE = re.compile(rf" ?(?:[{_LETTERS}]+|[{_MARKS}]+)")  # pieces that the pre-tokenizer leaves whole


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Ids(dict):
    """Ids of each piece; little-endian unsigned 32-bit numbers. Those met more than once are kept, the latest longest.

    Most pieces of a text occur once: ``met`` has a byte per hash of a piece, so that they do not fill the memo. Where pieces share a
    byte, one is kept that need not be. When half the memory is full, the pieces kept are set aside; those met again come back.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model, _byte_letters()
        self.aside, self.held, self.met = {}, 0, bytearray(MET)

    def set_aside(self) -> None:
        self.aside = dict(self)
        self.clear()
        self.held, self.met = 0, bytearray(MET)

    def __missing__(self, piece: str) -> bytes:
        value = self.aside.get(piece)
        if value is None:
            if SINGLE.fullmatch(piece):
                ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
            else:
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            value, at = pack(f"<{len(ids)}I", *ids), hash(piece) % MET
            if not self.met[at]:
                self.met[at] = 1
                return value
        self[piece] = value
        self.held += len(value) + len(piece) + 180
        return value


class Encoder:
    """Encodes texts piece by piece, exactly as the library does without begin, end or added tokens."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(FILE))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.any_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.ids = _Ids(self.tokenizer)
        self.sizes: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        """Pieces of the text. The library takes special strings out first, each one token; so do we."""
        if not any(s in text for s in self.special):
            return CUT.findall(text)
        return [p for i, x in enumerate(self.any_special.split(text)) for p in ([x] if i % 2 else CUT.findall(x))]

    def encode(self, text: str) -> bytes:
        """Ids of a text."""
        if self.ids.held > MEMO_BYTES // 2:
            self.ids.set_aside()
        return b"".join(map(self.ids.__getitem__, self.cut(text)))

    def lengths(self, texts: list[str]) -> list[int]:
        """Number of ids of each text. Pieces not met before go to the library as one batch."""
        if len(self.sizes) > MEMO_PIECES:
            self.sizes = {}
        cut = [self.cut(t) for t in texts]
        new = list(set(chain.from_iterable(cut)).difference(self.sizes))
        if new:
            made = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.sizes.update(zip(new, map(len, made)))
        size = self.sizes.__getitem__
        return [sum(map(size, pieces)) for pieces in cut]


@lru_cache(maxsize=1)
def worker_encoder(path: str | None = None) -> Encoder:
    """The encoder of this Python worker: tasks that run in it one after the other go on with the pieces it keeps."""
    return Encoder(path)


def by_bytes(texts: pa.Array, sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts): consecutive rows of at most ``limit`` bytes together, or one longer text."""
    start, size, held = 0, 0, []
    for i, (x, n) in enumerate(zip(texts, sizes)):
        if held and size + n > limit:
            yield start, held
            start, size, held = i, 0, []
        held.append(x.as_py())
        size += n
    if held:
        yield start, held


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. A missing text counts as empty.

    Only lengths leave Python. Repeated rows stay.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for b in batches:
            for start, texts in by_bytes(b.column(2), b.column(1).to_pylist()):
                n = pa.array(encoder.lengths(texts), pa.int64())
                part = b.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n], schema.names)

    text = text_or_empty()
    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("t")).mapInArrow(
        run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
