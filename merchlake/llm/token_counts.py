"""Token counts by field or section, from one encoding of the whole document.

Counting sections one by one gives other tokens at their edges than the
document has.  Here the document is encoded once; each token covers a span of
characters, the spans are interval-joined to the sections, and a token that
crosses an edge is allocated by a rule:

* ``first``: to the section that holds its first character;
* ``most``: to the section that holds most of its characters, the earlier of equals;
* ``split``: to each section by its share of the token's characters.

Both sides of the interval join are in order within a document, so the join
is a binary search inside the task that encodes the document, and no token
row is ever shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_tokens import byte_tokens
from .common import map_batches

RULES = ("first", "most", "split")


def token_spans(text: str, ids: np.ndarray, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of every token; characters count in code points.

    A token that begins or ends within a character covers that character.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum(byte_lengths[ids])
    if ends.size and ends[-1] != raw.size:
        raise ValueError("the tokens' bytes are not the text's bytes")
    starts = ends - byte_lengths[ids]
    if raw.size == len(text):
        return starts, ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    return char[starts], char[ends - 1] + 1


def allocate(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; sections are disjoint and in order. Tokens outside all sections count nowhere."""
    n = len(starts)
    out = np.zeros(n, np.float64)
    if not n or not begin.size:
        return out
    at = np.searchsorted(starts, begin, "right") - 1
    inside = (at >= 0) & (end <= stops[np.maximum(at, 0)])
    out += np.bincount(at[inside], minlength=n)
    for b, e, k in zip(begin[~inside], end[~inside], at[~inside], strict=True):  # the few that cross an edge
        k = max(k, 0)
        held = {}
        while k < n and starts[k] < e:
            over = min(e, stops[k]) - max(b, starts[k])
            if over > 0:
                held[k] = over
            k += 1
        if not held:
            continue
        if rule == "split":
            for k, over in held.items():
                out[k] += over / (e - b)
        elif rule == "most":
            out[max(held, key=lambda k: (held[k], -k))] += 1
        else:
            k = min(held)
            if starts[k] <= b:
                out[k] += 1
    return out


def line_sections(text: str) -> list[tuple[int, int]]:
    """The lines of a text, each with its line feed."""
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    out[-1] = (out[-1][0], len(text))
    return out if out[-1][0] < out[-1][1] or len(out) == 1 else out[:-1]


def token_counts(docs: DataFrame, tokenizer_path: str, rule: str = "first", sections: DataFrame | None = None) -> DataFrame:
    """doc_id, section, start, stop, n_tokens (double: whole unless rule is split) for every section of every row.

    sections (doc_id, section, start, stop) gives disjoint spans in
    characters, a document's share of which fits one task; without it
    the sections are the lines, numbered from 0, each with its line feed.  A
    null text has no sections; an empty one has one line without tokens.
    Rows that share a doc_id are counted each for itself; sections of a null doc_id belong to no document.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = sections is not None
    cols = docs.select("doc_id", "text")
    if given:
        spans = sections.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "section"))).alias("spans"))
        cols = cols.join(spans, "doc_id")

    def run(c: dict) -> pa.RecordBatch:
        enc = byte_tokens(tokenizer_path)
        sizes = enc.lengths()
        parts: tuple[list, ...] = ([], [], [], [], [])
        given_spans = c["spans"].to_pylist() if given else None
        for i, (doc, text) in enumerate(zip(c["doc_id"].to_pylist(), c["text"].to_pylist(), strict=True)):
            if text is None:
                continue
            if given:
                own = [(s["start"], s["stop"]) for s in given_spans[i]]
                names = [s["section"] for s in given_spans[i]]
            else:
                own = line_sections(text)
                names = range(len(own))
            starts, stops = np.array(own, np.int64).reshape(-1, 2).T
            begin, end = token_spans(text, np.frombuffer(enc.ids(text), "<u4"), sizes)
            for col, v in zip(parts, ([doc] * len(own), names, starts.tolist(), stops.tolist(), allocate(begin, end, starts, stops, rule).tolist()), strict=True):
                col.extend(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(parts, kinds, strict=True)], ["doc_id", "section", "start", "stop", "n_tokens"])

    return map_batches(cols, run, "doc_id long, section long, start long, stop long, n_tokens double")
