"""Quality rules: compression bands over whole texts and fixed chunks.

A text that says the same over and over compresses to very little; noise hardly
compresses at all.  Each text is compressed with zstandard as a whole, and, if
it is longer than a chunk, chunk by chunk (chunks of a fixed number of bytes, so
that a bad stretch inside a long text shows and texts of any length are measured
on one scale).  The ratio (compressed / raw bytes) must lie in a band that
depends on the length, because short texts compress less.

The base figures are counted with numpy on bytes: words end at ASCII white
space only, which never is a part of a longer UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import bounded_batches

#: Words of a window that counts as repeated.
WINDOW = 8
#: Bytes of a chunk; a rest shorter than half a chunk joins the last one.
CHUNK = 4096
LEVEL = 3
#: (bytes up to, least ratio, largest ratio) of a whole text or chunk.
BANDS = (
    (256, 0.45, 1.02),
    (1024, 0.40, 0.85),
    (4096, 0.42, 0.75),
    (1 << 62, 0.30, 0.70),
)
#: Share of chunks outside their band that fails a text.
BAD_CHUNKS = 0.34

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOLS = b"#*$%&|<>"


def _repeated(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more: exact, by naming runs of 1, 2, 4, 8 words with integers."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    names = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    size = 1
    while size < window:
        pair = names[:-size] * (int(names.max()) + 1) + names[size:]
        distinct, names = np.unique(pair, return_inverse=True)
        size *= 2
        if len(distinct) == len(pair):
            return 0
    again = np.bincount(names)[names] > 1
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def base_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = int(_SPACE[np.frombuffer(raw, np.uint8)].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else []
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
    )


def band(n_bytes: int) -> tuple[float, float]:
    return next((low, high) for most, low, high in BANDS if n_bytes <= most)


def compression(text: str | None, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """(whole ratio, chunks, chunks outside their band, within the bands); an empty text has ratio 1."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return 1.0, 0, 0, True
    whole = len(compressor.compress(raw)) / len(raw)
    low, high = band(len(raw))
    good, chunks, bad = low <= whole <= high, 1, 0
    if len(raw) > CHUNK:
        starts = list(range(0, len(raw), CHUNK))
        if len(raw) - starts[-1] < CHUNK // 2:
            starts.pop()
        chunks = len(starts)
        for k, a in enumerate(starts):
            part = raw[a : starts[k + 1] if k + 1 < chunks else len(raw)]
            ratio = len(compressor.compress(part)) / len(part)
            low, high = band(min(len(part), CHUNK))
            bad += not low <= ratio <= high
        good = good and bad <= BAD_CHUNKS * chunks
    return whole, chunks, bad, good


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long"
)


def _judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep as k0, k1, ... (their own names may be those of figures) and the figures."""
    names = [f"k{i}" for i in range(len(keep))]
    bounded_batches(docs.sparkSession)
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names, strict=True)], docs["text"].alias("t"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for pdf in batches:
            out = []
            for text in pdf["t"]:
                n, chars, symbols, dup, again = base_figures(text)
                failed = n < 20 or 100 * again > 30 * n
                ratio, chunks, bad, good = compression(text, compressor)
                out.append((n, chars, symbols, dup, again, failed, not failed and good, ratio, chunks, bad))
            figures = pd.DataFrame(out, columns=[x.split()[0] for x in FIGURES.split(", ")], index=pdf.index)
            yield pd.concat([pdf[names], figures], axis=1)

    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInPandas(judge, f"{kept}, {FIGURES}")


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the figures and the verdict of every row.

    NULL and empty texts have no words and fail the base rule.  Repeated rows
    are judged alike, an empty table gives no rows; a text is judged by itself,
    so neither order nor partitioning matters.  Other columns are ignored.
    """
    return _judged(docs, ["doc_id"]).withColumnRenamed("k0", "doc_id")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    judged = _judged(docs, docs.columns).where("kept")
    return judged.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
