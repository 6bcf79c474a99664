"""Splitting text into the pieces that byte-level BPE merges within.

The pattern is that of ``public_tokenizers.PATTERN``; it is not run as a regular
expression but worked out for a whole slice of documents at once, from the class
of each code point (letter, number, white space, other).  The classes are asked
of the tokenizer library itself, so its Unicode tables count."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken

from feedloom.llm.common import view

OTHER, LETTER, NUMBER, SPACE = range(4)
#: fixed values: the endings that the pattern splits off after an apostrophe
_ONE, _TWO = "stmd", ("re", "ve", "ll")


def code_point_classes() -> np.ndarray:
    """Class of every code point, by tiktoken's own \\p{L}, \\p{N} and \\s."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
    byte_ranks = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        enc = tiktoken.Encoding(f"class{kind}", pat_str=pattern, mergeable_ranks=byte_ranks, special_tokens={})
        found = bytes(enc.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def split(arr: pa.LargeBinaryArray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, piece offsets, pieces before each document): pieces of all texts back to back.

    Every byte belongs to one piece; no piece crosses a document."""
    data, off = view(arr)
    n = len(data)
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(off), np.int64)
    # code points; a byte that starts one is not 10xxxxxx
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(cp) != len(at):                      # not UTF-8: take the bytes as they are
        at, cp = np.arange(n), data.astype(np.uint32)
    m = len(cp)
    kind = classes[cp]
    doc = np.zeros(m + 1, bool)                 # first code point of a document, and the end
    doc[np.searchsorted(at, off)] = True
    first = doc[:-1].copy()
    first[0] = True
    run = first.copy()                          # where a run of one class starts
    run[1:] |= kind[1:] != kind[:-1]
    space, blank = kind == SPACE, cp == 32
    start = run.copy()
    # a blank joins the run after it; of longer white space the last one stands apart
    last = space.copy()
    last[:-1] &= ~space[1:] | first[1:]
    before_text = last.copy()
    before_text[-1] = False
    before_text[:-1] &= ~first[1:]
    start |= before_text
    joins = np.flatnonzero(before_text & blank)
    start[joins + 1] = False
    # an apostrophe alone, not joined to a blank, takes one of the endings along
    alone = (cp == 39) & start
    if m > 1:
        alone[:-1] &= ~first[1:]
        alone[-1] = False
        q = np.flatnonzero(alone)
        a = cp[q + 1]
        b = np.where((q + 2 < m) & ~doc[np.minimum(q + 2, m)], cp[np.minimum(q + 2, m - 1)], 0)
        one = np.isin(a, [ord(x) for x in _ONE])
        two = np.zeros(len(q), bool)
        for x, y in _TWO:
            two |= (a == ord(x)) & (b == ord(y))
        for hit, size in ((one, 1), (two, 2)):
            p = q[hit]
            start[p + 1] = False
            end = p + 1 + size
            end = end[end < m]
            start[end] |= kind[end] == LETTER   # what is left of the letters
    where = at[start]
    return data, np.append(where, n), np.searchsorted(where, off)
