r"""Token counts by a vocabulary of the tokenizers library.

Only lengths leave the Python workers. A text may be cut where a character that is
not white space is followed by one that is: byte-level pre-tokens never reach
across such a place, and special strings hold no white space, so the lengths of
the pieces add up to the length of the whole text. Texts are packed into batches
of equal size in UTF-8 bytes, long ones in several parts. Within a batch the segments between
safe places are counted once each, and lengths are remembered from batch to batch
up to a fixed number of segments.

Null texts count as empty. Repeated rows and null doc_ids keep their rows; an
empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cabrank.llm.common import text_of

# The characters with the White_Space property, which byte-level patterns call \s.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
SAFE = re.compile(f"[^{WHITE}](?=[{WHITE}])")
#: Bytes of text in a batch, and segments whose length is remembered.
BATCH = 1 << 20
REMEMBERED = 200_000
LIMIT = 1024


@functools.lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer of a file and the lengths known so far, once per worker; no more threads than the task has."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, {}


def bytes_in(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def parts(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` bytes, cut at safe places only."""
    start, step = 0, max(1, size // 32)
    while len(text) - start > step:
        end, held = start, 0
        while end < len(text) and held < size:
            held += bytes_in(text[end : end + step])
            end += step
        found = SAFE.search(text, end - 1) if end < len(text) else None
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def batches(texts: Iterable[str], size: int) -> Iterator[list[tuple[int, str]]]:
    """(number of the text, part) in batches of about ``size`` bytes."""
    batch, held = [], 0
    for number, text in enumerate(texts):
        for part in parts(text, size):
            batch.append((number, part))
            held += bytes_in(part)
            if held >= size:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def counts(texts: list[str], path: str, size: int = BATCH, remembered: int = REMEMBERED) -> np.ndarray:
    """The number of tokens of every text, in order."""
    tokenizer, known = load(path)
    totals = np.zeros(len(texts), np.int64)
    for batch in batches(texts, size):
        cut = [(number, SEGMENT.findall(part)) for number, part in batch]
        if len(known) > remembered:
            for segment in list(itertools.islice(known, len(known) // 2)):
                del known[segment]
        new = list({s for _, segments in cut for s in segments if s not in known})
        known.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        for number, segments in cut:
            totals[number] += sum(map(known.__getitem__, segments))
    return totals


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    @F.pandas_udf("long")
    def lengths(texts: pd.Series) -> pd.Series:
        return pd.Series(counts(texts.tolist(), path))

    counted = documents.select(
        "doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), lengths(text_of()).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
