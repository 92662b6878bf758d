"""Language identification by compression.

Each learned language gets a raw-content dictionary: lines of its training
texts (long ones in pieces), chosen by hash over all of them, ``dict_bytes`` in
all. A text is
compressed with every dictionary and gets the language whose output is
smallest. Texts are reduced to lower-case letter runs and compressed whole,
in windows of ``window`` bytes, so that a long text cannot become its own
dictionary. Short texts are compressed in several rotations of their words,
whose sizes are summed: one compression counts whole bytes only and would
tie too often.

``margin`` is the gap between the two smallest sizes over the larger of
them; under ``min_margin`` the text is rejected (``lang`` is ``und``), while
``lang_best`` still names the smallest. A tie goes to the language that
comes first. Rows that repeat a doc_id are identified each for itself; lines
that recur enter a dictionary once. A null text, and one without a letter, has ``lang_best`` =
``und`` and score 0; so has every text if nothing was learned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelens.llm.common import prepare, slices, unit_hash

UND = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Params:
    dict_bytes: int = 192 << 10
    #: Characters of a line that are drawn together at most.
    piece_chars: int = 2000
    window: int = 2048
    #: Texts under this many bytes are compressed in ``rotations`` word orders.
    short_bytes: int = 400
    rotations: int = 6
    min_margin: float = 0.01
    #: One dictionary is held for each language in every worker.
    max_languages: int = 1000
    #: Share of the probability lost per byte of size (natural log).
    sharpness: float = 0.15


def letters(text: str) -> bytes:
    return (" " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode("utf-8", "surrogatepass")


def learn(docs: DataFrame, params: Params = Params()) -> dict[str, bytes]:
    """Dictionaries by language from ``docs(text, lang)``: lines of a
    bounded sample, about ``dict_bytes`` for each language."""
    whole = docs.filter("lang is not null and text is not null").select("lang", F.explode(F.split("text", "\n")).alias("whole"))
    # Pieces of a bounded size, so that a draw of about 1.3 * dict_bytes is
    # many pieces, whatever the lines' length.
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("whole") / F.lit(params.piece_chars)).cast("int") - 1, F.lit(0)))
    lines = whole.select("lang", F.explode(F.transform(starts, lambda i: F.substring("whole", i * params.piece_chars + 1, params.piece_chars))).alias("line"))
    sizes = lines.groupBy("lang").agg(F.sum(F.length("line")).alias("chars")).limit(params.max_languages + 1).collect()
    if len(sizes) > params.max_languages:
        raise ValueError(f"more than {params.max_languages} languages")
    if not sizes:
        return {}
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * params.dict_bytes / max(r["chars"], 1))))])
    picked = lines.filter(unit_hash("line", F.lit(5)) < share[F.col("lang")]).distinct()
    out: dict[str, list[bytes]] = {r["lang"]: [] for r in sizes}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], hash_order(r["line"]))):
        out[r["lang"]].append(letters(r["line"]))
    return {k: b"".join(v)[-params.dict_bytes :] for k, v in sorted(out.items())}


def hash_order(line: str) -> tuple[int, str]:
    import zlib

    return zlib.crc32(line.encode("utf-8", "surrogatepass")), line


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes], params: Params):
        import zstandard as zs

        self.names, self.params, self.each = list(dictionaries), params, []
        setting = zs.ZstdCompressionParameters.from_level(
            6, min_match=4, search_log=4, strategy=zs.STRATEGY_GREEDY, window_log=20,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        for raw in dictionaries.values():
            if len(raw) < 8:  # too little for a dictionary
                self.each.append(zs.ZstdCompressor(compression_params=setting))
                continue
            d = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=setting)
            self.each.append(zs.ZstdCompressor(compression_params=setting, dict_data=d))

    def sizes(self, raw: bytes) -> np.ndarray:
        """Bytes of the text under each dictionary, mean over rotations."""
        p = self.params
        if len(raw) < p.short_bytes:
            words = raw.split()
            cuts = sorted({r * len(words) // p.rotations for r in range(p.rotations)})
            parts = [b" " + b" ".join(words[k:] + words[:k]) + b" " for k in cuts]
            over = len(parts)
        else:
            parts, over = [raw[i : i + p.window] for i in range(0, len(raw), p.window)], 1
        return np.array([sum(len(c.compress(x)) for x in parts) for c in self.each]) / over

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Best language, probability, margin."""
        raw = letters(text) if text else b""
        if not self.names or not raw.strip() or not any(map(str.isalpha, text)):
            return UND, 0.0, 0.0
        size = self.sizes(raw)
        best = int(size.argmin())
        rest = np.delete(size, best)
        second = rest.min() if len(rest) else size[best] * 2
        weight = np.exp(-self.params.sharpness * np.minimum(size - size[best], 400))
        return self.names[best], float(weight[best] / weight.sum()), float((second - size[best]) / max(second, 1))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], params: Params = Params()) -> DataFrame:
    """``doc_id, lang, lang_best, score, margin`` of each row of
    ``docs(doc_id, text)``; other columns are not read."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(dictionaries)

    def run(batches):
        import pyarrow as pa

        model = Compressors(shared.value, params)
        for batch in slices(batches, 2000):
            got = [model(t.as_py()) for t in batch.column("text")]
            best, score, margin = (list(x) for x in zip(*got)) if got else ([], [], [])
            lang = [b if m >= params.min_margin else UND for b, m in zip(best, margin)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                names=["doc_id", "lang", "lang_best", "score", "margin"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang string, lang_best string, score double, margin double")
