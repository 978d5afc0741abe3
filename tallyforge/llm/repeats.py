"""Suffix-array deduplication: remove every byte of a string that an earlier document holds too.

A byte goes if some WIDTH-byte string that covers it starts in a document of smaller doc_id as
well. Comparing all suffixes of a corpus in one place does not scale, so equal strings are first
brought together by anchors: the SEED-byte strings whose hash is least among those of some
WIDTH-byte string around them. Equal strings choose equal anchors. Then:

1. Every task reduces its texts to anchor hashes, packed by hash range; each range finds the
   hashes that two or more different texts hold. Equal texts count once, as their first document;
   the others are removed whole.
2. Texts with shared anchors send, for each, the bytes on both sides that a string through it can
   reach. The distinct contexts of an anchor form a text (the anchor itself is one symbol), and
   the suffix arrays of all such texts (suffix.py) put equal strings next to each other; the
   least document of each run keeps its string.
3. Anchors in more than HOT texts would gather without bound in one task. Their contexts are
   reduced to distinct ones, with partial sums, and equal strings meet by a join instead.
4. Strings found go back to their documents as spans.

The anchor's bytes are compared by a 64-bit hash, texts by 96 bits of an MD5; contexts byte by
byte. Null and empty texts, and those shorter than WIDTH, lose nothing. Repeated rows are one
document and each get a row. Rows that share a doc_id but not a text are judged apart, and neither
takes anything from the other. Rows without a doc_id lose nothing and take nothing away. An empty
table gives no rows. Other columns are ignored (`without_repeats` keeps them all).
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WORD, cut, freed, freed_group, input_bytes, mix, pieces, random_table, release, table, texts_of
from .suffix import ragged, suffix_arrays

#: Bytes of a repeated string, and of an anchor.
WIDTH, SEED = 50, 24
SIDE = WIDTH - SEED
#: Texts an anchor may be in to be handled in one task.
HOT = 16384
#: Bytes of input for each hash range and each part of the anchors, least number of them, anchors a
#: task holds at once, symbols in a batch of suffix arrays.
RANGE_BYTES, PART_BYTES, RANGES, PARTS, HELD, BATCH = 6 << 20, 3 << 20, 96, 48, 1 << 19, 1 << 19
#: Bytes of texts that are hashed at once.
STRETCH = 1 << 15
#: Ranges that the bits beside a narrowed hash can name; what is more is split by the hash itself.
NAMED = 1 << 15
_BYTES = random_table(256, 11)
LOW48 = U64((1 << 48) - 1)


def joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of strings made of those of a and, `shift` further right, those of b."""
    n = min(len(a), len(b) - shift)
    b = b[shift : shift + n]
    return (a[:n] * U64(0x9E3779B97F4A7C15) ^ (b >> U64(29))) + b * U64(0xC2B2AE3D27D4EB4F)


def string_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Hash of each string of `size` bytes, by doubling."""
    part, length, out, have = _BYTES[x], 1, None, 0
    while size >= length:
        if size & length:
            out, have = (part, length) if out is None else (joined(out, part, have), have + length)
        if size >= 2 * length:
            part = joined(part, part, length)
        length *= 2
    return mix(out)


def slid(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) over each run of `width` values."""
    size = 1
    while 2 * size <= width:
        x, size = best(x[:-size], x[size:]), 2 * size
    return best(x[: -(width - size)], x[width - size :]) if size < width else x


def anchors(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text, the positions of its anchors and their hashes. Texts are hashed end to end, some
    at a time, since most are short; strings of two texts choose nothing."""
    first, held = 0, 0
    for i, raw in enumerate(raws):
        held += len(raw)
        if held >= STRETCH or i == len(raws) - 1:
            yield from _anchors(raws[first : i + 1])
            first, held = i + 1, 0


def _anchors(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    x = np.frombuffer(b"".join(raws), dtype=np.uint8)
    base = np.cumsum([0, *map(len, raws)])
    if len(x) < WIDTH:
        at, h = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    else:
        h = string_hashes(x, SEED)
        low = np.zeros(len(h) + SIDE, dtype=U64)
        low[SIDE:-SIDE] = slid(h, SIDE + 1, np.minimum)
        for end in base[1:-1].tolist():
            low[max(0, end - WIDTH + 1) + SIDE : end + SIDE] = 0
        at = np.flatnonzero(slid(low, SIDE + 1, np.maximum) == h)
        h = h[at]
    edge = np.searchsorted(at, base).tolist()
    for start, i, j in zip(base.tolist(), edge, edge[1:], strict=False):
        yield at[i:j] - start, h[i:j]


def narrowed(h: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of a hash and 48 of its bits."""
    return ((h >> U64(48)) * U64(ranges) >> U64(16)).astype(np.int64), h & LOW48


def text_id(raw: bytes) -> bytes:
    return hashlib.md5(raw, usedforsecurity=False).digest()[:12]


def split(home: np.ndarray, low: np.ndarray, parts: int) -> np.ndarray:
    """The group of a hash: its range, which 16 bits name, in as many parts as the input's size asks for."""
    return home * parts + (low >> U64(32)).astype(np.int64) * parts // (1 << 16)


def sketches(ranges: int, parts: int = 1):
    """Stage 1, map side: (group, text ids, counts, hashes), each packed. A task sends a group what it has for
    it, so there are no more rows than hashes however many groups there are."""

    def flush(ids: list[bytes], found: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(found)
        own = np.repeat(np.arange(len(ids), dtype=np.int64), [len(x) for x in found])
        home, low = narrowed(h, ranges)
        home = split(home, low, parts)
        by = np.argsort(home, kind="stable")
        home, low, own = home[by], low[by], own[by]
        edge = np.flatnonzero(np.append(True, np.diff(home) != 0))
        six = np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
        all_ids = np.frombuffer(b"".join(ids), dtype=np.uint8).reshape(-1, 12)
        rows = []
        for a, b in zip(edge, np.append(edge[1:], len(home)), strict=True):
            head = np.flatnonzero(np.append(True, np.diff(own[a:b]) != 0))
            rows.append((int(home[a]), all_ids[own[a:b][head]].tobytes(), np.diff(np.append(head, b - a)).astype(np.uint32).tobytes(), six[a:b].tobytes()))
        k, a, b, c = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(c, pa.binary())], ["range", "ids", "counts", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, held = {}, [], 0
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                new = {own: raw for raw in texts_of(batch.column(0).slice(a, b - a)) if len(raw) >= WIDTH and (own := text_id(raw)) not in ids}
                for own, (_, h) in zip(new, anchors(list(new.values())), strict=True):
                    h = np.sort(h)
                    ids[own] = None
                    found.append(h[np.append(True, h[1:] != h[:-1])])
                    held += len(found[-1])
                    if held >= HELD:
                        yield flush(list(ids), found)
                        ids, found, held = {}, [], 0
        if found:
            yield flush(list(ids), found)

    return run


def shared(part: pa.Table, parts: int = 1) -> pa.Table:
    """Stage 1, one group: of each text, its hashes that other texts hold too (up to HOT in all, more)."""
    home = U64(part.column("range")[0].as_py() // parts)
    six = np.frombuffer(b"".join(part.column("hashes").to_pylist()), dtype=np.uint8).reshape(-1, 6)
    h = np.zeros((len(six), 8), dtype=np.uint8)
    h[:, :6] = six
    h = h.view("<u8").ravel()
    ids = np.frombuffer(b"".join(part.column("ids").to_pylist()), dtype=np.uint8).reshape(-1, 12)
    counts = np.frombuffer(b"".join(part.column("counts").to_pylist()), dtype=np.uint32)
    head, tail = np.ascontiguousarray(ids[:, :8]).view("<u8").ravel(), np.ascontiguousarray(ids[:, 8:]).view("<u4").ravel()
    by = np.lexsort((tail, head))
    number = np.empty(len(ids), dtype=np.int64)
    number[by] = np.cumsum(np.append(True, (np.diff(head[by]) != 0) | (np.diff(tail[by]) != 0))) - 1
    row = np.empty(int(number.max()) + 1, dtype=np.int64)
    row[number] = np.arange(len(ids))
    own = np.repeat(number, counts)
    by = np.lexsort((own, h))
    h, own = h[by], own[by]
    new = np.append(True, (np.diff(h) != 0) | (np.diff(own) != 0))
    h, own = h[new], own[new]
    start = np.flatnonzero(np.append(True, np.diff(h) != 0))
    size = np.diff(np.append(start, len(h)))
    size = np.repeat(size, size)
    keep = size > 1
    h, own, hot = h[keep] | home << U64(48), own[keep], size[keep] > HOT
    by = np.lexsort((hot, own))
    h, own, hot = h[by], own[by], hot[by]
    start = np.flatnonzero(np.append(True, np.diff(own) != 0)) if len(own) else np.zeros(0, dtype=np.int64)
    rows = []
    for a, b in zip(start, np.append(start[1:], len(own))[: len(start)], strict=True):
        m = a + int(np.searchsorted(hot[a:b], True))
        rows.append((ids[row[own[a]]].tobytes(), h[a:m].tobytes(), h[m:b].tobytes()))
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.table([pa.array(c, pa.binary()) for c in columns], names=["tid", "cold", "hot"])


def among(key: np.ndarray, of: list[bytes]) -> np.ndarray:
    """Which keys are among those packed in `of`."""
    known = np.sort(np.frombuffer(b"".join(of), dtype=U64))
    if not len(known):
        return np.zeros(len(key), dtype=bool)
    return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key


def contexts(ranges: int, homes: int):
    """Stage 2, map side: a row for each shared anchor of a text and each of its contexts there, with
    its places: 32-bit positions, after minus the text's ordinal if that is not 0.

    Anchors that a text holds once and that have SIDE bytes on both sides, as most do, become rows as
    arrays, many texts at once; the others are gathered by context one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1), 1 << 19):
                part = batch.slice(a, b - a)
                yield from laid_out(part.column(0).to_numpy(), texts_of(part.column(1)), *(part.column(c).to_pylist() for c in (2, 3, 4)))

    def laid_out(docs: np.ndarray, raws: list[bytes], cold: list, hot: list, ordinals: list[int]) -> Iterator[pa.RecordBatch]:
        found = []
        for i, (at, h) in enumerate(anchors(raws)):
            home, low = narrowed(h, ranges)
            key = low | home.astype(U64) << U64(48)
            is_hot = among(key, hot[i])
            k = np.flatnonzero(is_hot | among(key, cold[i]))
            found.append((at[k], h[k], is_hot[k]))
        at, h, is_hot = (np.concatenate([x[c] for x in found]) for c in range(3))
        text = np.repeat(np.arange(len(raws)), [len(x[0]) for x in found])
        size = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        by = np.lexsort((h, text))
        same = (h[by[1:]] == h[by[:-1]]) & (text[by[1:]] == text[by[:-1]])
        one = np.empty(len(h), dtype=bool)
        one[by] = ~(np.append(False, same) | np.append(same, False))[: len(h)]
        one &= (at >= SIDE) & (at + WIDTH <= size[text]) & (np.array(ordinals)[text] == 0)
        rest = np.flatnonzero(~one)
        if len(rest):
            yield packed(docs, raws, ordinals, text[rest].tolist(), at[rest].tolist(), h[rest].tolist(), is_hot[rest].tolist())
        at, h, is_hot, text = at[one], h[one], is_hot[one], text[one]
        if len(at):
            where = at + (np.cumsum(size) - size)[text]
            side = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(raws), dtype=np.uint8), SIDE)
            m = np.full((len(at), 2 + 2 * SIDE), SIDE, dtype=np.uint8)
            m[:, 2 : 2 + SIDE], m[:, 2 + SIDE :] = side[where - SIDE], side[where + SEED]
            home = np.where(is_hot, -1, (h % U64(homes)).astype(np.int32)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(h.view(np.int64)), pa.array(docs[text]), even(at.astype("<i4").view(np.uint8).reshape(-1, 4)), even(m)], names)

    def packed(docs, raws, ordinals, text, at, h, is_hot) -> pa.RecordBatch:
        found: dict[tuple, array] = {}
        for i, a, own, apart in zip(text, at, h, is_hot, strict=True):
            raw, ordinal = raws[i], ordinals[i]
            left, right = raw[max(0, a - SIDE) : a], raw[a + SEED : a + WIDTH]
            place = found.setdefault((i, apart, own, bytes((len(left), len(right))) + left + right), array("i", [-ordinal] if ordinal else []))
            place.append(a)
        rows = [(-1 if apart else own % homes, own - (1 << 64) if own >> 63 else own, int(docs[i]), place.tobytes(), context) for (i, apart, own, context), place in found.items()]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def even(m: np.ndarray) -> pa.Array:
        """Each row of m as a binary value."""
        return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer((np.arange(len(m) + 1) * m.shape[1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(m))])

    names = ["home", "h", "doc", "at", "context"]
    return run


def shared_length(unit: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Of each row, the longest beginning that another row of its unit has too; zeros pad rows."""
    wide = np.zeros((len(side), 32), dtype=np.uint8)
    wide[:, : side.shape[1]] = side
    by = np.lexsort((*wide.view(">u8").T[::-1], unit))
    side, unit = side[by], unit[by]
    same = np.zeros((len(side) + 1, side.shape[1] + 1), dtype=bool)
    same[1:-1, :-1] = (side[1:] == side[:-1]) & (side[1:] > 0) & (unit[1:] == unit[:-1])[:, None]
    length = np.argmin(same, axis=1)
    out = np.empty(len(side), dtype=np.int64)
    out[by] = np.maximum(length[:-1], length[1:])
    return out


def distinct_rows(unit: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal rows of a unit together, where each run starts, and the run of each row."""
    wide = np.zeros((len(m), -(-m.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : m.shape[1]] = m
    words = wide.view(">u8")
    by = np.lexsort((*words.T[::-1], unit))
    head = np.flatnonzero(np.append(True, (unit[by][1:] != unit[by][:-1]) | (words[by][1:] != words[by][:-1]).any(axis=1)))
    number = np.empty(len(m), dtype=np.int64)
    number[by] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(by))))
    return by, head, number


def least_documents(anchor: np.ndarray, least: np.ndarray, contexts_: list[bytes]) -> np.ndarray:
    """For distinct contexts sorted by anchor: the least document that holds the string which
    begins 0 .. SIDE bytes before the anchor, or a great number where there is no such string.

    Contexts are rows of symbols with the anchor in column SIDE: 1 ends a context, 2 stands for the
    anchor, bytes (of UTF-8, so at most 244) follow from 3, 0 is nothing. Ends of a row that no
    other context of the anchor shares belong to strings of one context, and are left out of the
    texts of the suffix arrays; rows then equal are one."""
    n, none = len(contexts_), np.iinfo(np.int64).max
    size = np.fromiter(map(len, contexts_), dtype=np.int64, count=n) - 2
    flat = np.frombuffer(b"".join(contexts_), dtype=np.uint8)
    at = np.cumsum(np.append(0, size[:-1] + 2))
    before, after = flat[at].astype(np.int64), flat[at + 1].astype(np.int64)
    back = np.arange(SIDE + 1)
    out = np.where((back <= before[:, None]) & (SIDE - back <= after[:, None]), least[:, None], none)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    many = np.diff(np.append(first, n))
    unit = np.repeat(np.arange(len(first)), many)
    # a single context shares nothing with another: its strings all begin in its own documents
    rows = np.flatnonzero(many[unit] > 1)
    if not len(rows):
        return out
    unit, before, size = unit[rows], before[rows], size[rows]
    m = np.zeros((len(rows), 2 * SIDE + 2), dtype=np.uint8)
    m[:, SIDE], m[:, -1] = 2, 1
    row, k = np.repeat(np.arange(len(rows)), size), ragged(np.zeros(len(rows), dtype=np.int64), size)
    m[row, SIDE - before[row] + k + (k >= before[row])] = flat[ragged(at[rows] + 2, size)] + 3
    left, right = shared_length(unit, m[:, SIDE - 1 :: -1]), shared_length(unit, m[:, SIDE + 1 : -1])
    keep = np.flatnonzero(left + right >= SIDE)
    if not len(keep):
        return out
    rows, unit, m, left, right = rows[keep], unit[keep], m[keep], left[keep], right[keep]
    m[:, :SIDE][np.arange(SIDE) < SIDE - left[:, None]] = 0
    m[:, SIDE + 1 : -1][np.arange(SIDE) >= right[:, None]] = 0
    by, head, number = distinct_rows(unit, m)
    low = np.minimum.reduceat(least[rows][by], head)
    pick = by[head]
    found = trimmed_least(unit[pick], m[pick], left[pick], right[pick], low)
    out[rows] = np.minimum(out[rows], found[number])
    return out


def trimmed_least(unit: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray) -> np.ndarray:
    """least_documents() of distinct rows, by suffix arrays of about BATCH symbols at a time.

    Where all rows of a unit agree on one side, as at the edge of a passage, that side and the
    anchor are one symbol; rows that agree on the left are read backwards for it."""
    back = np.arange(SIDE + 1)
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    many = np.diff(np.append(first, len(unit)))
    unit = np.repeat(np.arange(len(first)), many)
    origin = first[unit]
    same_left = np.logical_and.reduceat((m[:, :SIDE] == m[origin, :SIDE]).all(axis=1), first)[unit]
    same_right = np.logical_and.reduceat((m[:, SIDE + 1 : -1] == m[origin, SIDE + 1 : -1]).all(axis=1), first)[unit]
    turned = same_left & ~same_right
    m[turned, :-1] = m[turned, -2::-1]
    left, right = np.where(turned, right, left), np.where(turned, left, right)
    fits = (back <= left[:, None]) & (SIDE - back <= right[:, None])
    out = np.where(fits, low[:, None], np.iinfo(np.int64).max)
    one = same_left | same_right
    m[one, SIDE + 1 : -1] = 0
    reach = np.where(one, 0, SIDE)  # symbols of a string, with those `back` bytes: the anchor, and what follows
    cost = np.add.reduceat((m > 0).sum(axis=1), first)
    multi = np.flatnonzero(many > 1)
    order = multi[np.argsort(cost[multi], kind="stable")]
    done, total = 0, np.cumsum(cost[order])
    while done < len(order):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + BATCH, side="right")))
        units = order[done:stop]
        rows = ragged(first[units], many[units])
        out[rows] = sorted_least(unit[rows], m[rows], left[rows], reach[rows], fits[rows], low[rows], out[rows])
        done = stop
    out[turned] = out[turned, ::-1]
    return out


def sorted_least(unit, m, left, reach, fits, low, out) -> np.ndarray:
    """Build one text a unit, a symbol 0 at its end, sort the suffixes of all, and fill in out."""
    present = m > 0
    length = present.sum(axis=1)
    start = np.cumsum(length) - length
    codes = m[present].astype(np.int64)
    middle, end = start + left, start + length - 1
    last = np.append(unit[1:] != unit[:-1], True)
    codes[end[last]] = 0
    base = np.append(start[np.append(True, last[:-1])], len(codes))
    order = suffix_arrays(codes, base)
    # where strings begin: `back` bytes before the anchor
    which, back = np.nonzero(fits)
    owner = np.full(len(codes), -1, dtype=np.int64)
    owner[middle[which] - back] = np.arange(len(which))
    found = owner[order]
    found = found[found >= 0]
    begin, own, back, which = (middle[which] - back)[found], unit[which[found]], back[found], which[found]
    new = (own[1:] != own[:-1]) | (back[1:] != back[:-1])
    need = np.maximum(back, reach[which])[1:]
    for k in range(SIDE + 1):
        go = np.flatnonzero(~new & (k <= need))
        new[go] = codes[begin[1:][go] + k] != codes[begin[:-1][go] + k]
    runs = np.flatnonzero(np.append(True, new))
    least = np.minimum.reduceat(low[which], runs)
    out[which, back] = np.repeat(least, np.diff(np.append(runs, len(which))))
    return out


def covered(part: pa.Table) -> pa.Table:
    """Stage 2, a part of the anchors: (doc, at, mask of the strings an earlier document holds)."""
    h, doc = (part.column(c).to_numpy() for c in ("h", "doc"))
    code = part.column("context").combine_chunks().dictionary_encode()
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    number, words = code.indices.to_numpy().astype(np.int64), code.dictionary.to_pylist()
    by = np.lexsort((doc, number, h))
    head = np.flatnonzero(np.append(True, (np.diff(h[by]) != 0) | (np.diff(number[by]) != 0)))
    first = by[head]
    least = least_documents(h[first], doc[first], [words[i] for i in number[first].tolist()])
    row = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(by))))
    doc = doc[by]
    mask = np.zeros(len(by), dtype=np.int64)
    for back in range(SIDE + 1):
        mask |= (least[row, back] < doc).astype(np.int64) << back
    keep = np.flatnonzero(mask)
    return pa.table([pa.array(doc[keep], pa.int64()), part.column("at").take(pa.array(by[keep])), pa.array(mask[keep], pa.int64())], names=["doc", "at", "mask"])


def covered_hot(rows: DataFrame) -> DataFrame:
    """As covered(), for anchors in many texts: equal strings meet by their bytes."""
    distinct = rows.groupBy("h", "context").agg(F.min("doc").alias("least"))
    before, after = (F.conv(F.hex(F.substring("context", i, 1)), 16, 10).cast("int") for i in (1, 2))
    strings = distinct.select("h", "context", "least", before.alias("n"), after.alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SIDE))).alias("back"))
    strings = strings.where(f"back <= n AND {SIDE} - back <= m").withColumn("string", F.expr(f"substring(context, 3 + n - back, {SIDE})"))
    best = strings.groupBy("h", "back", "string").agg(F.min("least").alias("low"))
    met = strings.join(best, ["h", "back", "string"]).groupBy("h", "context").agg(F.collect_list(F.struct("back", "low")).alias("lows"))
    bits = F.expr("aggregate(lows, 0L, (m, x) -> m | if(x.low < doc, shiftleft(1L, x.back), 0L))")
    return rows.join(met, ["h", "context"]).select("doc", "at", bits.alias("mask")).where("mask != 0")


def places(found, ordinal: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and masks of the text of that ordinal, of the rows (at, mask) of its doc_id."""
    if found is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed, mask = found.field(0).to_pylist(), found.field(1).to_numpy()
    size = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
    at, row = np.frombuffer(b"".join(packed), dtype=np.int32), np.repeat(np.arange(len(packed)), size)
    first = at[np.cumsum(size) - size]
    fits = (np.where(first < 0, -first, 0)[row] == ordinal) & (at >= 0)
    return at[fits], mask[row[fits]]


def spans(size: int, whole: bool, at: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the removed runs of a text."""
    if whole and size >= WIDTH:
        return np.array([0]), np.array([size])
    if not len(at):
        return at, at
    i, back = np.nonzero(mask[:, None] >> np.arange(SIDE + 1) & 1)
    begin = np.unique(at[i].astype(np.int64) - back)
    # a run goes on as long as the next string begins before, or where, the last one ends
    apart = np.diff(begin) > WIDTH
    return begin[np.append(True, apart)], begin[np.append(apart, True)] + WIDTH


def left_over(raw: bytes, start: list[int], end: list[int], characters: bool) -> bytes:
    """What is left of a text without its runs; with `characters`, without those of which a run holds a part, too."""
    out, at = [], 0
    for a, b in zip(start, end, strict=True):
        while characters and a and raw[a] & 0xC0 == 0x80:
            a -= 1
        while characters and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b += 1
        out.append(raw[at : max(a, at)])
        at = max(at, b)
    return b"".join([*out, raw[at:]])


def applied(batches: Iterator[pa.RecordBatch], characters: bool = False) -> Iterator[pa.RecordBatch]:
    """Stage 4: texts (doc, body, tid, copies, ordinals, found, rest) to their runs and what is left."""
    for batch in batches:
        for a, b in pieces(batch.column(1)):
            rows = []
            part = batch.slice(a, b - a)
            for raw, tid, copies, ordinals, found in zip(texts_of(part.column(1)), *(part.column(k).to_pylist() for k in (2, 3, 4)), part.column(5), strict=True):
                ordinal = next((x["ordinal"] for x in ordinals or () if x["tid"] == tid), 0)
                start, end = spans(len(raw), tid in (copies or ()), *places(found.values, ordinal))
                rows.append((len(raw), left_over(raw, start.tolist(), end.tolist(), characters), start.tolist(), end.tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *part.columns[6:]], ["key", "n_bytes", "kept", "starts", "ends", *(["rest"] if part.num_columns > 6 else [])])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", rest: bool = False, characters: bool = False) -> DataFrame:
    """One row per document: key, n_bytes, kept (the bytes left; with `characters`, without the rest of
    characters that are cut), starts and ends of removed runs, and, if asked for, `rest`, a struct of its other columns."""
    spark = docs.sparkSession
    size = input_bytes(docs, text)
    groups, homes = max(RANGES, size // RANGE_BYTES), max(PARTS, size // PART_BYTES)
    parts = -(-groups // NAMED)
    ranges = -(-groups // parts)
    raw = F.coalesce(F.col(text), F.lit(""))
    others = [F.struct(*(docs[c] for c in docs.columns if c != text)).alias("rest")] if rest else []
    own = docs.select(*others, F.col(key).alias("doc"), raw.alias("body"), F.unhex(F.substring(F.md5(raw), 1, 24)).alias("tid"))

    packed = own.select("body").mapInArrow(freed(sketches(ranges, parts)), "range int, ids binary, counts binary, hashes binary")
    found = cut(packed.groupBy("range").applyInArrow(freed_group(partial(shared, parts=parts)), "tid binary, cold binary, hot binary"), "shared")
    first = own.groupBy("tid").agg(F.min("doc").alias("first"))
    # texts of a doc_id beyond its first are told apart by an ordinal; as a rule there are none
    several = own.where("doc IS NOT NULL").select("doc", "tid").distinct().withColumn("ordinal", F.row_number().over(Window.partitionBy("doc").orderBy("tid")) - 1)
    several = cut(several.where("ordinal > 0"), "ordinals", tidy=False)
    wanted = found.groupBy("tid").agg(F.collect_list("cold").alias("cold"), F.collect_list("hot").alias("hot")).join(first, "tid")
    wanted = wanted.select(F.col("first").alias("doc"), "tid", "cold", "hot").join(several, ["doc", "tid"], "left").fillna(0, ["ordinal"])
    sent = own.join(wanted, ["doc", "tid"]).dropDuplicates(["doc", "tid"])
    sent = sent.select("doc", "body", "cold", "hot", "ordinal").mapInArrow(freed(contexts(ranges, homes)), "home int, h long, doc long, at binary, context binary")
    sent = cut(sent, "contexts")
    release(found)
    cold = sent.where("home >= 0").groupBy("home").applyInArrow(freed_group(covered), "doc long, at binary, mask long")
    masks = cut(cold.unionByName(covered_hot(sent.where("home < 0").select("h", "doc", "at", "context"))), "masks")
    release(sent)

    by_doc = masks.groupBy("doc").agg(F.collect_list(F.struct("at", "mask")).alias("found"))
    copies = own.select("doc", "tid").join(first, "tid").where("doc > first").groupBy("doc").agg(F.collect_set("tid").alias("copies"))
    by_ordinal = several.groupBy("doc").agg(F.collect_list(F.struct("tid", "ordinal")).alias("ordinals"))
    marks = by_doc.join(copies, "doc", "full").join(by_ordinal, "doc", "full")
    also = ["rest"] if rest else []
    out = own.select("doc", "body", "tid", *also).join(marks, "doc", "left").select("doc", "body", "tid", "copies", "ordinals", "found", *also)
    schema = T.StructType.fromDDL("key long, n_bytes long, kept binary, starts array<long>, ends array<long>")
    for c in also:
        schema = schema.add(out.schema[c])
    return out.mapInArrow(freed(partial(applied, characters=characters)), schema).withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", chars: str = "n_chars") -> DataFrame:
    """The documents with their texts cut, and their columns as they were but for text and chars
    (the text's length, if there is such a column). Characters of which a part was removed go
    whole, and nothing else does; documents that lose their last word go."""
    found = remove_repeats(docs, text, key, rest=True, characters=True)
    touched = F.size("starts") > 0
    body = F.col("kept").cast("string")
    rows = found.select("rest", body.alias("body"), touched.alias("touched")).where(~F.col("touched") | F.rlike("body", F.lit(WORD)))

    def column(c: str):
        if c == text:
            return F.col("body").alias(c)
        if c == chars:
            return F.when(F.col("touched"), F.length("body")).otherwise(F.col("rest")[c]).cast(docs.schema[c].dataType).alias(c)
        return F.col("rest")[c].alias(c)

    return rows.select(*map(column, docs.columns))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.expr("aggregate(zip_with(ends, starts, (e, s) -> e - s), 0L, (a, b) -> a + b)")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
