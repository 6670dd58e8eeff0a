"""Token counts by section or field, from one encoding of the whole document.

A document is encoded once; token lengths give byte spans, those give character spans, and an interval join (binary search of
the sorted bounds) attributes tokens to sections. Counting each section on its own would give other numbers, because tokens may
cross the boundaries. Rules for a token that crosses:

* ``majority``: the section that holds most of its characters, the earlier on a tie (default);
* ``start``: the section of its first character; ``end``: that of its last.

A token that holds part of a character's bytes counts as that character. Counts add up to the tokens of the document.

Defined cases: a null or empty text has no sections and no tokens; a section without characters has none; fields that are null
are empty; null ids, repeated rows and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import load, rank_file
from quire.llm.common import arrow_map, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = ("majority", "start", "end")


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """A library encoder and the byte length of each token."""
    import tiktoken

    path, pattern = rank_file(vocabulary)
    coder = load(path, pattern)
    return tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=coder.ranks, special_tokens={}), np.array([len(b) for b in coder.table], np.int64)


def spans(text: str, vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last."""
    coder, sizes = encoder(vocabulary)
    ids = coder.encode_ordinary(text)
    if not ids:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    if text.isascii():
        return starts, ends
    character = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, int]:
    """Tokens of each section [bounds[i], bounds[i + 1]) and how many tokens cross a boundary."""
    first, last = np.searchsorted(bounds, starts, "right") - 1, np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    owner = last.copy() if rule == "end" else first
    if rule == "majority":
        for t in crossing:
            edges = np.clip(bounds[first[t] : last[t] + 2], starts[t], ends[t])
            owner[t] = first[t] + int(np.argmax(np.diff(edges)))
    return np.bincount(owner, minlength=len(bounds) - 1), len(crossing)


def _bounds(lengths) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def section_counts(docs: DataFrame, separator: str = "\n", rule: str = "majority", vocabulary: str = VOCABULARY) -> DataFrame:
    """Sections end with the separator, which belongs to them. doc_id, n_tokens, n_chars, n_sections, n_crossing and
    section_tokens, the tokens of each section in order."""
    assert rule in RULES and separator

    def rows(batches):
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                if not text:
                    out.append((0, 0, 0, 0, []))
                    continue
                lengths = [len(p) + len(separator) for p in text.split(separator)]
                lengths[-1] -= len(separator)
                if not lengths[-1]:
                    lengths.pop()
                starts, ends = spans(text, vocabulary)
                counts, crossing = attribute(starts, ends, _bounds(lengths), rule)
                out.append((len(starts), len(text), len(lengths), crossing, counts))
            yield [batch.column(0), *map(list, zip(*out, strict=True))]

    schema = "doc_id long, n_tokens long, n_chars long, n_sections int, n_crossing int, section_tokens array<int>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), schema, rows)


def field_counts(rows: DataFrame, key: str, fields: list[str], joiner: str = "\n", rule: str = "majority", vocabulary: str = VOCABULARY) -> DataFrame:
    """Fields joined to one text and encoded once; a joiner belongs to the field before it. key, n_tokens, field_tokens."""
    assert rule in RULES

    def out(batches):
        for batch in slices(batches):
            totals, counts = [], []
            for parts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                parts = [p or "" for p in parts]
                lengths = [len(p) + len(joiner) for p in parts[:-1]] + [len(parts[-1])]
                starts, ends = spans(joiner.join(parts), vocabulary)
                totals.append(len(starts))
                counts.append(attribute(starts, ends, _bounds(lengths), rule)[0])
            yield [batch.column(0), totals, counts]

    kept = rows.select(F.col(key).cast("string").alias("key"), *(F.col(f).cast("string") for f in fields))
    return arrow_map(kept, "key string, n_tokens long, field_tokens array<int>", out)


def op10_tokencount(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, from whole-document encodings."""
    return section_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
