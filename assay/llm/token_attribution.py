"""Token counts with offset-mapped attribution (operator 6).

A whole text is encoded once. Byte-level BPE is lossless, so the running sum of the tokens' byte lengths gives each token's
exact span. Spans are interval-joined to sections by binary search. A token that crosses a boundary goes, by `rule`,

* "start": to the section that holds its first byte (the default),
* "majority": to the section that holds most of its bytes, the first of equals,
* "split": to all its sections in proportion to bytes, as fractions.

Sections are half-open byte ranges that partition the text. `lines` makes one of every line with its line feed; `fields`
joins several columns and makes one of each, so that fields are counted in the context in which they are encoded.

Defined results: a null or empty text has no tokens and one section, with 0 tokens. Rows are encoded one by one: repeated
rows get equal results; memory is bounded by the longest text. Strings of special tokens count as ordinary text. An empty
table gives an empty result; columns named like an output are replaced. Fields are encoded as they are, U+0000 included.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES = ("start", "majority", "split")
_LOADED: dict[tuple[str, str], tuple] = {}


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(path, split pattern) of one of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encoder(path: str, pattern: str):
    """(encoding, byte length of each token) from a file of base64 tokens and ranks; loaded once a process."""
    if (path, pattern) not in _LOADED:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _LOADED[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size
    return _LOADED[path, pattern]


def lines(text: str) -> np.ndarray:
    """Byte positions at which the lines of a text end; the last is the text's length."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero(raw[:-1] == 10) + 1, len(raw)) if len(raw) else np.zeros(1, np.int64)


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary), from the end positions of tokens and of sections."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(bounds, starts, "right")
    last = np.searchsorted(bounds, ends, "left")
    crossing = np.flatnonzero(last > first)
    out = np.bincount(first, minlength=len(bounds)).astype(np.float64)[: len(bounds)]
    if rule == "start" or not len(crossing):
        return out, len(crossing)
    left = np.concatenate([[0], bounds[:-1]])
    for t in crossing.tolist():
        part = np.arange(first[t], last[t] + 1)
        size = np.minimum(ends[t], bounds[part]) - np.maximum(starts[t], left[part])
        out[first[t]] -= 1
        if rule == "majority":
            out[part[size.argmax()]] += 1
        else:
            out[part] += size / size.sum()
    return out, len(crossing)


def count_tokens(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None, pattern: str | None = None, rule: str = "start", sections: Callable[[str], np.ndarray] = lines) -> DataFrame:
    """The columns `keep` with n_tokens, n_crossing and section_tokens, an array with a number for each section."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    if path is None or pattern is None:
        path, pattern = vocabulary()
    keep = [c for c in keep if c not in ("n_tokens", "n_crossing", "section_tokens")]
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("n_crossing", "long").add("section_tokens", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, size = encoder(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                n, crossing, counts = [], [], []
                for cell in part.column("__text"):
                    value = cell.as_py() or ""
                    ends = np.cumsum(size[np.asarray(encoding.encode_ordinary(value), np.int64)]) if value else np.zeros(0, np.int64)
                    per, over = attribute(ends, sections(value), rule)
                    n.append(len(ends))
                    crossing.append(over)
                    counts.append(per)
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, pa.array(n, pa.int64()), pa.array(crossing, pa.int64()), pa.array(counts, pa.list_(pa.float64()))], names=[*keep, "n_tokens", "n_crossing", "section_tokens"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def count_field_tokens(rows: DataFrame, keep: list[str], fields: list[str], separator: str = "\n", path: str | None = None, pattern: str | None = None, rule: str = "start") -> DataFrame:
    """count_tokens over the fields of a record, encoded together as they are; null fields are empty.

    A field's section takes the separator after it. The sections are the fields in order.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    if path is None or pattern is None:
        path, pattern = vocabulary()
    keep = [c for c in keep if c not in ("n_tokens", "n_crossing", "section_tokens")]
    cells = F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    schema = rows.select(*keep).schema.add("n_tokens", "long").add("n_crossing", "long").add("section_tokens", T.ArrayType(T.DoubleType()))
    gap = len(separator.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, size = encoder(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                n, crossing, counts = [], [], []
                for cell in part.column("__fields"):
                    parts = cell.as_py()
                    bounds = np.cumsum([len(p.encode()) + gap * (i + 1 < len(parts)) for i, p in enumerate(parts)])
                    ends = np.cumsum(size[np.asarray(encoding.encode_ordinary(separator.join(parts)), np.int64)])
                    per, over = attribute(ends, bounds, rule)
                    n.append(len(ends))
                    crossing.append(over)
                    counts.append(per)
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, pa.array(n, pa.int64()), pa.array(crossing, pa.int64()), pa.array(counts, pa.list_(pa.float64()))], names=[*keep, "n_tokens", "n_crossing", "section_tokens"])

    return rows.select(*keep, cells.alias("__fields")).mapInArrow(run, schema)
