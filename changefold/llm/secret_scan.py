"""Secret scans: known shapes, and strings that a tokenizer finds hard to spell.

Words of any language take a few characters a token; random strings take few. A candidate
string with letters whose characters-per-token ratio is low counts as a secret, unless it
has the shape of a digest or of an identifier made of words. A candidate is looked at as a
whole and, if that is no secret, part by part, so words before a secret do not hide it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.llm.bpe import read_ranks
from changefold.llm.frames import annotate

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 8
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 16
HEX = re.compile(r"[0-9a-f]{32,}")
#: What may be random: a run of the characters of base64 and its relatives.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Its parts: between '/' and '=', and between all marks.
PARTS = (re.compile(r"[A-Za-z0-9+_-]{16,}"), re.compile(r"[A-Za-z0-9]{16,}"))
#: Letters alone, written like a word, are tested from this length on: shorter ones are often
#: rare or compound words.
LETTERS_CHARS = 20
#: Fewer characters a token than this is no language.
CHARS_PER_TOKEN = 2.3
#: Lengths of digests in hex digits: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = frozenset({32, 40, 56, 64, 96, 128})
ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Letters in a row of an identifier that have to be language: fewer have no telling ratio.
PART_CHARS = 8
#: Parts of an identifier: words and numbers, not mixed.
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@lru_cache(2)
def encoding(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def is_language(words: list[str], enc) -> bool:
    """Whether the ratio is that of words; capitals count as small letters if that helps."""
    n = sum(map(len, words))
    return any(n >= CHARS_PER_TOKEN * sum(len(enc.encode_ordinary(w)) for w in spelled)
               for spelled in (words, [w.lower() for w in words]))


def is_known(text: str, enc) -> bool:
    """Digests, UUIDs, and identifiers that are words and numbers joined by marks."""
    if ALL_HEX.fullmatch(text) and len(text) in DIGESTS or UUID.fullmatch(text):
        return True
    parts = [p for p in re.split(r"[-_/+=]+", text) if p]
    if not (all(p.isalpha() or p.isdigit() for p in parts) or (
            len(parts) > 1 and all(len(NAME_PARTS.findall(p)) <= 2 for p in parts))):
        return False
    # Short parts are names and abbreviations; a long one has to be language.
    words = [w for p in parts for w in re.findall("[A-Za-z]+", p) if len(w) >= PART_CHARS]
    return is_language(words, enc) if words else len(parts) > 1


def is_random(text: str, enc) -> bool:
    if not any(c.isalpha() for c in text):
        return False
    if text.isalpha() and (text.isupper() or text[1:].islower()) and len(text) < LETTERS_CHARS:
        return False
    if is_known(text, enc):
        return False
    return len(text) < CHARS_PER_TOKEN * len(enc.encode_ordinary(text))


def randoms(text: str, enc) -> Iterator[tuple[int, int]]:
    """Random strings in order: whole candidates, else the parts of one that are random."""
    def look(a: int, b: int, level: int, new: bool = True) -> Iterator[tuple[int, int]]:
        if new and is_random(text[a:b], enc):
            yield a, b
        elif level < len(PARTS) and not UUID.fullmatch(text, a, b):
            for m in PARTS[level].finditer(text, a, b):
                yield from look(*m.span(), level + 1, m.span() != (a, b))

    for m in CANDIDATE.finditer(text):
        yield from look(*m.span(), 0)


def spans_of(text: str, enc) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind.

    Known shapes are found leftmost and without overlap per kind; a random string inside one
    of them is not told twice.
    """
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b in found)
    k, reach = 0, -1
    for a, b in randoms(text, enc):
        while k < len(base) and base[k][0] <= a:
            reach = max(reach, base[k][1])
            k += 1
        if reach < b:
            found.append(("random", a, b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _work(column: pa.Array, path: str, pattern: str) -> list:
    enc = encoding(path, pattern)
    return [[[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t, enc)] for t in column.to_pylist()]]


def scan(docs: DataFrame, path: str, pattern: str, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``spans`` of each text: none in a null or empty one; each row by itself."""
    return annotate(docs, partial(_work, path=path, pattern=pattern),
                    "spans array<struct<kind:string,start:int,end:int>>", keep=keep, text=text)


def told(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
