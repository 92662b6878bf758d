"""Text expressions (X1-X15, N1, N2, F2, F3, P9), all JVM-side.

Java's ``\\s`` is ASCII-only; ``(?U)`` makes it Unicode-aware, matching the
reference, which strips no-break spaces too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (equal to the reference's cleaning rules, in Java syntax).
RX_PIPE = r"(?U)\s*\|\s*"  # genres: a pipe with any spaces around it
RX_WS = r"(?U)\s+"  # runs of whitespace
RX_NOT_TAG_CHAR = r"[^a-z0-9 ]"  # characters dropped from tags
RX_STRIP = r"(?U)^\s+|\s+$"  # leading and trailing whitespace
RX_TOKEN = r"[\p{L}\p{N}_]{2,}"  # tokens: runs of two or more word characters


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Unicode strip (``F.trim`` removes only the space character)."""
    return F.regexp_replace(_col(c), RX_STRIP, "")


def normalize_genres(c) -> Column:
    """Cast, lower case, pipes to one space, strip."""
    return strip_ws(F.regexp_replace(F.lower(_col(c).cast("string")), RX_PIPE, " "))


def normalize_tag(c) -> Column:
    """N2 (per value): cast, lower, collapse whitespace, strip, drop
    everything outside ``[a-z0-9 ]``, then spaces to underscores.

    The drop comes after the strip, so ``! mafia`` becomes ``_mafia`` and an
    all-symbol tag becomes the empty string (parity).
    """
    t = F.regexp_replace(F.lower(_col(c).cast("string")), RX_WS, " ")
    t = F.regexp_replace(strip_ws(t), RX_NOT_TAG_CHAR, "")
    return F.regexp_replace(t, " ", "_")


def collapse_ws(c) -> Column:
    """Whitespace runs to one space, then strip."""
    return strip_ws(F.regexp_replace(_col(c), RX_WS, " "))


def sorted_unique_words(c) -> Column:
    """Split on one space, drop repeats, sort (byte order), join with a space."""
    return F.array_join(F.array_sort(F.array_distinct(F.split(_col(c), " "))), " ")


def tokens(c) -> Column:
    """lower case, then maximal runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(RX_TOKEN), 0)


def ngrams(tok: Column, ngram_range: tuple = (1, 2)) -> Column:
    """all n-grams with n in ``ngram_range``, words joined by a space,
    unigrams first, then bigrams, each in text order.

    An (n+1)-gram is an n-gram zipped with the token after it, so every
    position costs one concatenation whatever the text's length. ``tok``
    should be a column, not an expression to evaluate again.
    """
    lo, hi = ngram_range
    parts, grams = [], tok
    for n in range(1, hi + 1):
        if n > 1:
            count = F.greatest(F.size(tok) - F.lit(n - 1), F.lit(0))
            grams = F.zip_with(F.slice(grams, 1, count), F.slice(tok, n, count), lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= lo:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def display_genres(c) -> Column:
    """``|`` to ``, `` then ``,`` to ``, ``; ``A|B`` shows as ``A,  B``."""
    once = F.replace(_col(c).cast("string"), F.lit("|"), F.lit(", "))
    return F.replace(once, F.lit(","), F.lit(", "))
