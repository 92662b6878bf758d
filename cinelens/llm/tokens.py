"""Token ids and character spans of whole texts, and their counts by section.

*Encoding.* The tokenizer file (a parameter) is read once on the driver and
broadcast. Texts of plain Latin letters, digits, marks and white space are
split at white space, which this tokenizer drops and never merges across, and
every distinct part of a word is encoded once in a worker; all other texts, and
those that hold the string of an added token, are encoded whole. Either way the
ids are those of the tokenizer, as its file sets it up, for the whole text.

Rows that repeat a doc_id or a text are encoded each for itself.

*Attribution* (``section_counts``). A document is encoded once. Its tokens'
character spans, which are sorted, are joined to its sections by binary
search on the section bounds (an interval join in O(sections * log tokens)).
A token that crosses a section bound is dealt by ``rule``:

- ``first``   to the section holding its first character;
- ``middle``  to the section holding its middle character (the earlier of two);
- ``split``   to each section by the share of its characters there.

Sections may overlap or leave gaps: a token counts in every section that the
rule names, or in none.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import prepare, slices

RULES = ("first", "middle", "split")
#: Words a worker keeps encoded; past it the table starts afresh.
CACHE_WORDS = 300_000
# Characters whose lower case and composed form are one character each, and
# which the tokenizer's pattern splits at white space alike: ASCII without
# rare controls, Latin-1 letters, the two inverted marks.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡¿-ÖØ-öø-ÿ]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


# How the tokenizer's pattern cuts lower-case plain text within a word.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class _Parts(dict):
    """Part of a word (letters, a digit, marks) to the ids of its tokens."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        coded = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
        ids = [t.id for t in self.model.tokenize(coded)]
        self[part] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out


class _Ids(dict):
    """Word to the little-endian 32-bit ids of its tokens."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.parts = tokenizer, _Parts(tokenizer.model)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = b"".join(map(self.parts.__getitem__, _PARTS.findall(word)))
        return out


class _Spans(_Ids):
    """Word to the character spans of its tokens, as pairs."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        spans = self.tokenizer.encode(word, add_special_tokens=False).offsets
        self[word] = out = np.array(spans, "<u4").tobytes()
        return out


class Encoder:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._ids, self._spans = _Ids(self.tokenizer), _Spans(self.tokenizer)

    def _words(self, text: str) -> list[str] | None:
        """Lower-cased words of a text that can be encoded word by word."""
        if not _PLAIN.fullmatch(text):
            return None
        lower = text.lower()
        return None if any(t in lower for t in self.added) else lower.split()

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if (words := self._words(text)) is not None:
            return b"".join(map(self._ids.__getitem__, words))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def spans(self, text: str | None) -> np.ndarray:
        """Character spans, one row (start, end) for each token."""
        if not text:
            return np.empty((0, 2), np.int64)
        if (words := self._words(text)) is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        parts = list(map(self._spans.__getitem__, words))
        if not parts:
            return np.empty((0, 2), np.int64)
        chars = np.frombuffer(text.encode("latin-1"), np.uint8)
        solid = chars > 32
        starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
        tokens = np.fromiter(map(len, parts), np.int64, len(parts)) // 8
        inner = np.frombuffer(b"".join(parts), "<u4").reshape(-1, 2).astype(np.int64)
        return inner + np.repeat(starts, tokens)[:, None]


_ENCODERS: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One encoder for each worker and tokenizer, with its word tables."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def count_in(spans: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section [lo, hi) under ``rule``."""
    hi = np.maximum(hi, lo)
    if not len(spans):
        return np.zeros(len(lo))
    if rule == "split":
        order = np.argsort(spans[:, 0], kind="stable")
        start, end = spans[order, 0], np.maximum(spans[order, 1], spans[order, 0] + 1)
        last = np.maximum.accumulate(end)

        def before(x):
            done = np.searchsorted(last, x, "right")
            out = done.astype(float)
            for i, (a, b) in enumerate(zip(done, np.searchsorted(start, x, "left"))):
                if b > a:
                    out[i] += np.minimum((x[i] - start[a:b]) / (end[a:b] - start[a:b]), 1.0).sum()
            return out

        return before(hi) - before(lo)
    at = spans[:, 0] if rule == "first" else (spans[:, 0] + np.maximum(spans[:, 1] - 1, spans[:, 0])) // 2
    at = np.sort(at)
    return (np.searchsorted(at, hi, "left") - np.searchsorted(at, lo, "left")).astype(float)


def section_counts(docs: DataFrame, rule: str = "first", tokenizer: str | None = None) -> DataFrame:
    """``doc_id, section, start, end, tokens, doc_tokens`` of each section.

    ``docs(doc_id, text, sections)``; ``sections`` is an array of structs
    ``(start, end)`` of character positions, end excluded. ``section`` is the
    place in that array from 0, ``tokens`` a double (whole unless ``split``).
    A null text has no tokens; a document without sections has no row; a
    null section, or one with a null bound, is skipped.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is not one of {RULES}")
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(read(tokenizer or default_path()))

    def run(batches):
        import pyarrow as pa

        enc = encoder(shared.value)
        for batch in slices(batches):
            ids, out = batch.column("doc_id"), {k: [] for k in ("at", "section", "start", "end", "tokens", "doc_tokens")}
            for i, (text, sections) in enumerate(zip(batch.column("text").to_pylist(), batch.column("sections").to_pylist())):
                kept = [(n, s["start"], s["end"]) for n, s in enumerate(sections or ()) if s and None not in (s["start"], s["end"])]
                if not kept:
                    continue
                spans = enc.spans(text)
                number, lo, hi = np.array(kept, np.int64).T
                out["at"].append(np.full(len(kept), i))
                out["doc_tokens"].append(np.full(len(kept), len(spans)))
                for k, v in (("section", number), ("start", lo), ("end", hi), ("tokens", count_in(spans, lo, hi, rule))):
                    out[k].append(v)
            if out["at"]:
                cols = {k: np.concatenate(v) for k, v in out.items()}
                at = cols.pop("at")
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *map(pa.array, cols.values())], names=["doc_id", *cols])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "sections").mapInArrow(
        run, f"doc_id {kind}, section long, start long, end long, tokens double, doc_tokens long")


def pages(text, chars: int):
    """Sections of ``chars`` characters that tile a text; one empty section
    for an empty or null text."""
    n = F.coalesce(F.length(text), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(chars)).cast("int") - 1, F.lit(0))),
        lambda i: F.struct((i * chars).alias("start"), F.least((i + 1) * chars, n).alias("end")))
