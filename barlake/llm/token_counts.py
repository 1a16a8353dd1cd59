"""Token counts by section: whole documents are encoded once, token spans are joined to section intervals.

A token belongs to the section that holds most of its characters; of equal
shares the earlier section gets it.  So every token is counted exactly once and
the sections of a document add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from barlake.llm.common import bounded_batches
from barlake.llm.tokens import offset_encoder

Sections = Callable[[str], tuple[list[str], np.ndarray]]


def lines(text: str) -> tuple[list[str], np.ndarray]:
    """Sections of a plain text: the first line is the head, further lines are body; a line end belongs to its line.

    Returns kinds and the section starts; sections are adjacent and cover the text.
    """
    starts = [0]
    at = text.find("\n") + 1
    while at and at < len(text):
        starts.append(at)
        at = text.find("\n", at) + 1
    return ["head"] + ["body"] * (len(starts) - 1), np.array(starts, np.int64)


def attribute(spans: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) by section: an interval join of token spans with adjacent sections."""
    n = len(starts)
    ends = np.append(starts[1:], length)
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.maximum(first, np.searchsorted(starts, np.maximum(spans[:, 1] - 1, spans[:, 0]), "right") - 1)
    crossing = first != last
    home = first.copy()
    for k in np.flatnonzero(crossing):
        own = np.arange(first[k], last[k] + 1)
        share = np.minimum(ends[own], spans[k, 1]) - np.maximum(starts[own], spans[k, 0])
        home[k] = own[int(np.argmax(share))]
    return np.bincount(home, minlength=n), np.bincount(home[crossing], minlength=n)


def section_tokens(docs: DataFrame, tokenizer: str, sections: Sections = lines) -> DataFrame:
    """(doc_id, section, kind, start, end, n_tokens, n_crossing), a row for each section of each row of ``docs``.

    A NULL or empty text has one empty section with no tokens.  Repeated rows
    give repeated results, an empty table none; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = offset_encoder(tokenizer)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                text = text or ""
                kinds, starts = sections(text)
                tokens, crossing = attribute(encode.spans(text), starts, len(text))
                out.append(
                    pd.DataFrame(
                        {
                            "doc_id": doc,
                            "section": np.arange(len(starts)),
                            "kind": kinds,
                            "start": starts,
                            "end": np.append(starts[1:], len(text)),
                            "n_tokens": tokens,
                            "n_crossing": crossing,
                        }
                    )
                )
            if out:
                yield pd.concat(out, ignore_index=True)

    return docs.select("doc_id", "text").mapInPandas(
        count,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, section long, kind string, start long, end long, "
        "n_tokens long, n_crossing long",
    )
