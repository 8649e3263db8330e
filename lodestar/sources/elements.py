"""Elements of JSON pages, by a structural scan.

A page is not parsed as a whole.  Its structural bytes are found by array
operations: a byte after an odd run of backslashes is escaped; a byte is inside
a string if an odd number of unescaped quotes stands before it; the depth is the
prefix sum of the opening and closing brackets outside strings.  Commas at the
depth of the list part its elements, and each element is parsed by itself: a
broken one is lost alone, and memory holds a page's bytes and the places of its
structural bytes, never a tree of the page.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

OUT_BYTES = 1 << 23      # element bytes handed on at a time
BLANKS = b" \t\r\n"


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, bytes, depth behind each, places of unescaped quotes) of the
    brackets, commas and colons outside strings."""
    slash = np.flatnonzero(data == 0x5C)
    escaped = np.zeros(0, np.int64)
    if len(slash):
        first = np.append(True, np.diff(slash) > 1)
        start = np.flatnonzero(first)
        run = np.diff(np.append(start, len(slash)))
        escaped = slash[start][run % 2 == 1] + run[run % 2 == 1]
    quote = np.flatnonzero(data == 0x22)
    quote = quote[~np.isin(quote, escaped, assume_unique=True)]
    signs = np.flatnonzero(np.isin(data, np.frombuffer(b"[]{},:", np.uint8)))
    signs = signs[np.searchsorted(quote, signs) % 2 == 0]
    kind = data[signs]
    step = np.isin(kind, (0x5B, 0x7B)).astype(np.int64) - np.isin(kind, (0x5D, 0x7D))
    return signs, kind, np.cumsum(step), quote


def list_elements(page: bytes, member: str | None = None) -> list[bytes]:
    """Elements of the list that ``page`` is, or of the list under the key
    ``member`` of the object that it is (the last such key); none if it is
    something else.  A list that ends early gives the elements before its end."""
    import json
    data = np.frombuffer(page, np.uint8)
    signs, kind, depth, _ = structure(data)
    opener = 0x5B if member is None else 0x7B
    if not len(signs) or kind[0] != opener or page[:int(signs[0])].strip(BLANKS):
        return []
    begin, level = 0, 1                                    # index of the list's bracket, depth inside it
    if member is not None:
        edges = np.flatnonzero((depth == 1) & ((kind == 0x2C) | (kind == 0x7B)))
        colons = np.flatnonzero((depth == 1) & (kind == 0x3A))
        begin = None
        for e in edges.tolist():
            c = int(np.searchsorted(colons, e))
            if c == len(colons) or c + 1 < len(colons) and colons[c] < e:
                continue
            colon = int(colons[c])
            try:
                name = json.loads(page[int(signs[e]) + 1:int(signs[colon])])
            except ValueError:
                continue
            if name == member:
                value = colon + 1
                is_list = (value < len(signs) and kind[value] == 0x5B
                           and not page[int(signs[colon]) + 1:int(signs[value])].strip(BLANKS))
                begin, level = (value if is_list else None), 2
        if begin is None:
            return []
    closers = np.flatnonzero((depth[begin + 1:] < level)) + begin + 1
    end = int(closers[0]) if len(closers) else len(signs)
    inside = slice(begin + 1, end)
    commas = signs[inside][(kind[inside] == 0x2C) & (depth[inside] == level)]
    stop = [int(signs[end])] if end < len(signs) else []   # an element without an end is none
    edges = [int(signs[begin]), *commas.tolist(), *stop]
    parts = [page[a + 1:b].strip(BLANKS) for a, b in zip(edges, edges[1:])]
    return parts if len(parts) != 1 or parts[0] else []


def split_pages(member: str | None):
    """Batches (kept columns, payload) -> (kept columns, pos, element)."""
    def run(batches):
        for batch in batches:
            pages = batch.column(batch.num_columns - 1)
            kept = batch.select(batch.schema.names[:-1])
            rows, pos, out, size = [], [], [], 0

            def flush():
                take = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [*[c.take(take) for c in kept.columns], pa.array(pos, pa.int32()), pa.array(out, pa.string())],
                    [*kept.schema.names, "pos", "element"])

            for k in range(len(pages)):
                page = pages[k].as_py()
                for i, e in enumerate(list_elements(page.encode(), member) if page else []):
                    rows.append(k)
                    pos.append(i)
                    out.append(e.decode())
                    size += len(e)
                    if size > OUT_BYTES:
                        yield flush()
                        rows, pos, out, size = [], [], [], 0
            yield flush()
    return run
