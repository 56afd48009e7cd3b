"""Byte-level BPE: encoding with the tokenizers library, decoding by the byte table.

The vocabulary comes as a rank file (base64 token, rank). Bytes are written as visible
characters, so that the library's merges work on text; every way to make a token of two
others is a merge at that token's rank, which is the rule of the rank file.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import annotate

#: Characters that are encoded in one call.
CALL_CHARS = 1 << 20
#: Stretches of text whose ids a worker remembers at most (about 100 MB).
REMEMBERED = 500_000
#: The characters that Unicode calls white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: No piece goes on from a visible character to white space, nor from a letter or digit to
#: an ASCII mark. So the ids of the stretches of a text, each with the white space before
#: it, are the ids of the text.
STRETCH = re.compile(
    f"[{SPACE}]*[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[!-/:-@\\[-`{{-~])"
    f"|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Stretches that are encoded as one text.
TOGETHER = 1000


def byte_characters() -> list[str]:
    """The character for each byte: itself if it is visible, else one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    moved = {b: 256 + k for k, b in enumerate(hidden)}
    return [chr(moved.get(b, b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encodes and decodes by a rank file and the pattern that cuts a text into pieces."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        self.bytes_of = byte_characters()
        back = {c: b for b, c in enumerate(self.bytes_of)}
        vocabulary = {"".join(self.bytes_of[b] for b in token): rank for token, rank in ranks.items()}
        merges = [
            (word[:i], word[i:]) for word in sorted(vocabulary, key=vocabulary.get)
            for i in range(1, len(word)) if word[:i] in vocabulary and word[i:] in vocabulary
        ]
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        #: The byte table reversed: what each id stands for.
        self.table = {rank: bytes(back[c] for c in word) for word, rank in vocabulary.items()}
        self.lengths = np.zeros(max(self.table) + 1, np.int64)
        for rank, token in self.table.items():
            self.lengths[rank] = len(token)
        self.known: dict[str, bytes] = {}

    def encoded(self, texts: Iterable[str]) -> Iterator:
        """The library's encodings, with ids and character offsets, a few at a time."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > CALL_CHARS:
                yield from self.tokenizer.encode_batch(held, add_special_tokens=False)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self.tokenizer.encode_batch(held, add_special_tokens=False)

    def learn(self, parts: Sequence[str]) -> None:
        """Remember the ids of stretches, as little-endian 32-bit integers.

        Stretches from a blank to a visible character are encoded one behind the other, as
        no piece crosses their borders, and told apart by their bytes.
        """
        whole = [p for p in parts if p[0] == " " and not p[-1].isspace()]
        for lo in range(0, len(whole), TOGETHER):
            some = whole[lo:lo + TOGETHER]
            found = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            sizes = np.fromiter((len(p.encode()) for p in some), np.int64, len(some))
            ends = 4 * (np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes)) + 1)
            data, start = ids.tobytes(), 0
            for p, end in zip(some, ends.tolist(), strict=True):
                self.known[p] = data[start:end]
                start = end
        rest = [p for p in parts if p[0] != " " or p[-1].isspace()]
        for p, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[p] = np.array(found.ids, "<u4").tobytes()

    def packed(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        held: list[list[str]] = []
        size = 0

        def ready() -> Iterator[bytes]:
            new = list({p for parts in held for p in parts if p not in self.known})
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
                new = list({p for parts in held for p in parts})
            self.learn(new)
            for parts in held:
                yield b"".join(map(self.known.__getitem__, parts))

        for text in texts:
            held.append(STRETCH.findall(text))
            size += len(text)
            if size > CALL_CHARS:
                yield from ready()
                held, size = [], 0
        yield from ready()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of each id as it becomes known: a character whose bytes are split over
        ids comes with the last of them."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield reader.decode(self.table[i])


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker."""
    return Codec(path, pattern)


def _tokens(column: pa.Array, path: str, pattern: str) -> list:
    found = [(e.ids, e.offsets) for e in codec(path, pattern).encoded(column.to_pylist())]
    return [[ids for ids, _ in found], [[a for a, _ in at] for _, at in found],
            [[b for _, b in at] for _, at in found]]


def _texts(ids: pa.Array, path: str, pattern: str) -> list:
    return [[codec(path, pattern).decode(x) if x is not None else None for x in ids.to_pylist()]]


def _digests(column: pa.Array, path: str, pattern: str) -> list:
    own, rows = codec(path, pattern), []
    for packed in own.packed(column.to_pylist()):
        ids = np.frombuffer(packed, "<u4").tolist()
        rows.append((len(ids), hashlib.sha256(packed).hexdigest(),
                     hashlib.sha256(own.decode_bytes(ids)).hexdigest()))
    return [list(x) for x in zip(*rows, strict=True)]


def encode(docs: DataFrame, path: str, pattern: str, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and for each text its ids and the characters [start, end) each stands for
    (ids that share a character have the same). A null or empty text has no ids."""
    return annotate(docs, partial(_tokens, path=path, pattern=pattern),
                    "ids array<int>, starts array<int>, ends array<int>", keep=keep, text=text)


def decode(tokens: DataFrame, path: str, pattern: str, *, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` and the ``text`` of a column of ids; a null list is a null text, bytes that
    are no character become U+FFFD."""
    asked = tokens.withColumn("__none", F.lit(""))
    return annotate(asked, lambda _, column: _texts(column, path, pattern), "text string",
                    keep=keep, text="__none", also=[ids])


def digests(docs: DataFrame, path: str, pattern: str, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the number of ids, SHA-256 of the ids as little-endian 32-bit integers, and
    SHA-256 of the bytes decoded from them. Null is taken as empty; each row by itself.

    Texts are cut where no match of ``public_tokenizers.PATTERN`` goes on, and the ids of a
    piece are remembered; another pattern, for which that is not proven, is refused.
    """
    if pattern != public_tokenizers.PATTERN:
        raise ValueError("digests() cuts texts by public_tokenizers.PATTERN; use encode() for other patterns")
    return annotate(docs, partial(_digests, path=path, pattern=pattern),
                    "n_tokens bigint, ids_sha256 string, decoded_sha256 string", keep=keep, text=text)
