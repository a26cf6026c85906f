"""Suffix-array deduplication with a run-length index (operator 7).

Every byte covered by a ``length``-byte string that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed.  The result is exact.

1. *Anchors.*  Of the ``KGRAM``-byte strings inside a ``length``-byte window the one
   with the smallest hash is its anchor: equal windows have equal anchors at equal
   places.  Neighbouring windows with one anchor form a segment.  Tasks send the
   anchors' hashes of a batch to hash shards, which answer with those that occur in
   two different texts or twice in one; other windows cannot repeat.
2. *Segments.*  Only segments with such an anchor travel, to the anchor's shard.
   Equal segments of a batch travel once: the later ones are repeats as they stand.
3. *Run-length index.*  A shard joins its different segments to blocks (whole anchors,
   in document order) and builds the Burrows-Wheeler transform of each, as runs of
   equal symbols with the suffix-array sample at the run ends.  Only those samples
   get their match length by comparison; streaming over the text from sample to sample
   gives the matching statistics of all other places, as both the match and its
   source move by one.  Places matching over ``length`` bytes are grouped in suffix
   order, and all but the first in document order are marked.
   An anchor that could have more bytes of segments than ``HOT_BLOCKS`` blocks is in no
   shard: its windows travel one by one, as 128-bit hashes, to the window's own shard, where
   all but the first in document order are marked.  Equal windows of a batch travel once.
4. Marked ranges meet their texts, and the bytes that remain are hashed.

Exact copies of a text are found by its hash beforehand, so a large group of copies
sends its text's segments once and its other members nothing.

Defined results: null and empty texts have 0 bytes; texts under ``length`` bytes
keep all; rows with equal id and text are one document (equal results); a row
without id comes after all others; of equal ids with different texts the order is
that of a hash of the text; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import fresh, shards_for, written
from flightlake.llm.textkit import prefix_hash, span_hash, text_blocks

#: Bytes of a repeat, bytes of an anchor.
LENGTH, KGRAM = 100, 24
#: Documents of a batch, text bytes per anchor shard, bytes of an index block.
BATCH_ROWS, SHARD_BYTES, BLOCK = 4096, 16 << 20, 1 << 20
#: An anchor shard takes the anchors of so many index shards' texts (an anchor is far smaller than its segment).
ANCHOR_FACTOR = 4
#: Blocks of segments beyond which an anchor is hot, shards of windows per index shard, windows a batch holds before they go.
HOT_BLOCKS, WINDOW_FACTOR, HELD_WINDOWS = 4, 16, 50_000
#: Places handled by one pass; their number fits into PLACE_BITS.
STRETCH, PLACE_BITS = 1 << 21, np.uint64(22)
_LAST = (1 << 63) - 1


def segments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, kgram: int = KGRAM
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window, anchor hash and document of every segment of a block of texts."""
    out: list[tuple] = []
    for lo in range(0, max(len(data) - length + 1, 0), STRETCH):
        part = data[lo: lo + STRETCH + length - 1]
        n = len(part) - length + 1
        sums = prefix_hash(part)
        at = np.arange(len(part) - kgram + 1)
        h = span_hash(sums, at, at + kgram)
        # smallest hash of each window, its leftmost place in the low bits
        low = ((h >> PLACE_BITS) << PLACE_BITS) | at.astype(np.uint64)
        width, have = length - kgram + 1, 1
        while have < width:
            step = min(have, width - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        place = (low & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)[:n]
        doc = np.searchsorted(bounds, lo + np.arange(n), side="right") - 1
        valid = lo + np.arange(n) + length <= bounds[doc + 1]
        start = valid.copy()
        start[1:] &= (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
        first = np.flatnonzero(start)
        stop = valid.copy()
        stop[:-1] &= start[1:] | ~valid[1:]
        last = np.flatnonzero(stop)
        out.append((first + lo, last + lo, h[place[first]], doc[first]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))  # type: ignore[return-value]


# -- anchors -------------------------------------------------------------------------------------------------

_ANCHOR_SQL = "grp long, batch long, head boolean, anchors binary, docs binary, texts binary"
_ANCHOR = pa.schema([("grp", pa.int64()), ("batch", pa.int64()), ("head", pa.bool_()), ("anchors", pa.binary()),
                     ("docs", pa.binary()), ("texts", pa.binary())])


def _shard_rows(anchors: np.ndarray, docs: np.ndarray, texts: np.ndarray, shards: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """What a batch sends to each shard: anchors, their documents' places, and the text hashes of just these documents.

    At most 18 bytes an anchor, whatever the number of shards.
    """
    shard = (anchors % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    a, d, shard = anchors[order].astype("<u8"), docs[order].astype("<u2"), shard[order]
    names, first = np.unique(shard, return_index=True)
    stop = np.append(first[1:], len(a))[:len(names)]
    for s, lo, hi in zip(names.tolist(), first.tolist(), stop.tolist(), strict=True):
        yield s, a[lo:hi].tobytes(), d[lo:hi].tobytes(), texts[np.unique(d[lo:hi])].astype("<u8").tobytes()


def _anchor_packer(shards: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(lo, BATCH_ROWS)
                anchors, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                texts = np.zeros(batch.num_rows, np.uint64)
                for row, data, bounds in text_blocks(batch.column(1)):
                    _, _, a, d = segments(data, bounds, length)
                    anchors.append(a)
                    docs.append(d + row)
                for i, t in enumerate(batch.column(2)):
                    texts[i] = int(t.as_py()[:16], 16)
                keys = "\n".join(batch.column(0).to_pylist()).encode()
                rows = [(-1 - number, number, True, keys, b"", b""),
                        *((s, number, False, *blobs) for s, *blobs in
                          _shard_rows(np.concatenate(anchors), np.concatenate(docs), texts, shards))]
                for k in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(_ANCHOR.names, r, strict=True)) for r in rows[k:k + 64]],
                                                     schema=_ANCHOR)
                number += 1
    return run


def _repeated_anchors(hot_from: int):
    """A shard: the anchors in two texts or twice in a document, told to every batch.

    ``texts`` of an answer tells which of them are hot: those of ``hot_from`` segments and more, copies of a text aside.
    """
    def run(table: pa.Table) -> pa.Table:
        return _answer(table, hot_from)
    return run


def _answer(table: pa.Table, hot_from: int) -> pa.Table:
    if table.column("head")[0].as_py():
        return table
    anchors = [np.frombuffer(x.as_py(), "<u8") for x in table.column("anchors")]
    docs = [np.frombuffer(x.as_py(), "<u2") for x in table.column("docs")]
    text = np.concatenate([np.frombuffer(t.as_py(), "<u8")[np.unique(d, return_inverse=True)[1]]
                           for t, d in zip(table.column("texts"), docs, strict=True)])
    size = np.cumsum([0] + [len(a) for a in anchors])
    a = np.concatenate(anchors)
    row = np.repeat(np.arange(len(anchors)), np.diff(size)) * 65536 + np.concatenate(docs)
    order = np.lexsort((row, text, a))
    same = a[order][1:] == a[order][:-1]
    # a neighbour in sorted order with the same anchor and another text, or the same document again
    other = same & ((text[order][1:] != text[order][:-1]) | (row[order][1:] == row[order][:-1]))
    begin = np.concatenate([[True], ~same])
    number = np.cumsum(begin) - 1
    found = np.zeros(int(number[-1]) + 1, bool)
    found[number[1:][other]] = True
    hit = np.empty(len(a), bool)
    hit[order] = found[number]
    # occurrences in the first row of each text
    of_text = np.concatenate([[True], ~same | (text[order][1:] != text[order][:-1])])
    first_row = row[order][np.flatnonzero(of_text)][np.cumsum(of_text) - 1]
    hot = np.empty(len(a), bool)
    hot[order] = np.bincount(number, weights=row[order] == first_row)[number] >= hot_from
    out = []
    for k, batch in enumerate(table.column("batch").to_pylist()):
        mine = np.flatnonzero(hit[size[k]:size[k + 1]])
        if len(mine):
            out.append((table.column("grp")[0].as_py(), batch, False, anchors[k][mine].tobytes(), docs[k][mine].tobytes(),
                        hot[size[k]:size[k + 1]][mine].tobytes()))
    return pa.Table.from_pylist([dict(zip(_ANCHOR.names, r, strict=True)) for r in out], schema=_ANCHOR)


def _by_document(table: pa.Table) -> pa.Table:
    """A batch: the repeated anchors of each of its documents, and the hot ones of them."""
    rows = table.to_pylist()
    keys = next(r for r in rows if r["head"])["anchors"].decode().split("\n")
    answers = [r for r in rows if not r["head"]]
    names, blobs, hots = [], [], []
    if answers:
        a = np.concatenate([np.frombuffer(r["anchors"], "<u8") for r in answers])
        d = np.concatenate([np.frombuffer(r["docs"], "<u2") for r in answers])
        hot = np.concatenate([np.frombuffer(r["texts"], bool) for r in answers])
        order = np.lexsort((a, d))
        a, d, hot = a[order], d[order], hot[order]
        for i in np.unique(d).tolist():
            lo, hi = np.searchsorted(d, [i, i + 1])
            names.append(keys[i])
            blobs.append(np.unique(a[lo:hi]).tobytes())
            hots.append(np.unique(a[lo:hi][hot[lo:hi]]).tobytes())
    return pa.table({"key": pa.array(names, pa.string()), "anchors": pa.array(blobs, pa.binary()), "hot": pa.array(hots, pa.binary())})


# -- segments and the run-length index -----------------------------------------------------------------------

_SEG_SQL = "grp long, anchor long, bytes binary, ord long, key string, pos long"
_SEG = pa.schema([("grp", pa.int64()), ("anchor", pa.int64()), ("bytes", pa.binary()), ("ord", pa.int64()),
                  ("key", pa.string()), ("pos", pa.int64())])
_MARK_SQL = "key string, marks binary"


def _seg_batches(out: list[tuple]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(out), 20_000):
        cols = list(zip(*out[k:k + 20_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SEG, strict=True)], schema=_SEG)


def _window_rows(windows: dict[bytes, tuple], shards: int) -> list[tuple]:
    """Windows of hot anchors, in shards behind those of the segments."""
    return [(shards + int.from_bytes(w[:8], "little") % (WINDOW_FACTOR * shards), 0, w, o, k, p) for w, (o, k, p) in windows.items()]


def _cutter(shards: int, length: int):
    """Segments with repeated anchors; of equal ones in a batch the first in document order, the others as marks.

    Of hot anchors the same with windows instead of segments.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS // 4):
                batch = whole.slice(lo, BATCH_ROWS // 4)
                ords, keys, wanted, heat = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
                best: dict[bytes, tuple] = {}
                windows: dict[bytes, tuple] = {}
                marks: dict[str, list[int]] = {}
                for row, data, bounds in text_blocks(batch.column(2)):
                    first, last, anchor, doc = segments(data, bounds, length)
                    cut = np.searchsorted(doc, np.arange(len(bounds)))
                    raw = data.tobytes()
                    for i in range(len(bounds) - 1):
                        a, b = int(cut[i]), int(cut[i + 1])
                        mine = np.flatnonzero(np.isin(anchor[a:b], np.frombuffer(wanted[row + i], "<u8"))) + a
                        hot = np.isin(anchor[mine], np.frombuffer(heat[row + i], "<u8"))
                        who, o, base = keys[row + i], ords[row + i], int(bounds[i])
                        for f, e, h, many in zip(first[mine].tolist(), last[mine].tolist(), anchor[mine].tolist(), hot.tolist(), strict=True):
                            if many:
                                for p in range(f, e + 1):
                                    w = hashlib.blake2b(raw[p:p + length], digest_size=16).digest()
                                    mark, seen = (o, who, p - base), windows.get(w)
                                    if seen is None:
                                        windows[w] = mark
                                        continue
                                    windows[w], late = min(seen, mark), max(seen, mark)
                                    own = marks.setdefault(late[1], [])
                                    if own and own[-2] <= late[2] <= own[-1]:  # follows the mark before
                                        own[-1] = max(own[-1], late[2] + length)
                                    else:
                                        own.extend((late[2], late[2] + length))
                                if len(windows) >= HELD_WINDOWS:
                                    yield from _seg_batches(_window_rows(windows, shards))
                                    windows = {}
                                continue
                            text = raw[f:e + length]
                            new, old = (o, who, f - base, h), best.get(text)
                            if old is None:
                                best[text] = new
                                continue
                            later = max(old, new)
                            best[text] = min(old, new)
                            marks.setdefault(later[1], []).extend((later[2], later[2] + len(text)))
                out = [(int(h % shards), h - (1 << 64) if h >> 63 else h, t, o, k, p) for t, (o, k, p, h) in best.items()]
                out += _window_rows(windows, shards)
                out += [(-1 - int(k[:8], 16) % shards, 0, np.array(m, "<i8").tobytes(), 0, k, 0) for k, m in marks.items()]
                yield from _seg_batches(out)
    return run


def run_index(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a text whose 0 symbols are separators (each different, in order), and its inverse.

    Prefix doubling from seven packed symbols; a suffix that reaches its separator is unique.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)  # no separator so far
    for j in range(7):
        s = padded[j:j + n]
        alive &= s > 0
        key = (key << 9) | np.where(alive, s, 0)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (sorted_key[1:] & 511 == 0)  # ended: unique
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    depth = 7
    while not new.all():
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - depth, 0)] = rank[depth:] + 1
        # only suffixes of classes with several members are sorted on
        loose = np.flatnonzero(~(new & np.append(new[1:], True)))
        rows = order[loose]
        k = rank[rows] * (n + 1) + ahead[rows]
        sub = np.argsort(k, kind="stable")
        order[loose] = rows[sub]
        k = k[sub]
        differs = np.ones(len(loose), bool)
        differs[1:] = k[1:] != k[:-1]
        new[loose] |= differs
        # ranks by place in the order, so that finished classes keep theirs
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = head
        depth *= 2
    return order, rank


def matching_statistics(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, int]:
    """Length of the match of every place with its predecessor in suffix order, and the number of runs.

    The transform is kept as runs; a place whose symbol heads a run is a sample and
    is compared directly, from sample to sample the lengths follow by counting.
    """
    n = len(symbols)
    before = np.where(order > 0, symbols[order - 1], 0)
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    heads = np.flatnonzero(head)
    sample = np.unique(np.append((order[heads] - 1)[order[heads] > 0], n - 1))
    at = rank[sample]
    source = np.where(at > 0, order[at - 1], -1)
    length = np.zeros(len(sample), np.int64)
    live = np.flatnonzero(source >= 0)
    while len(live):
        x, y = sample[live] + length[live], source[live] + length[live]
        ok = (x < n) & (y < n)
        ok[ok] = (symbols[x[ok]] == symbols[y[ok]]) & (symbols[x[ok]] > 0)
        live = live[ok]
        length[live] += 1
    k = np.searchsorted(sample, np.arange(n))
    return length[k] + sample[k] - np.arange(n), len(heads)


def later_windows(parts: list[bytes], doc: np.ndarray, pos: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Per segment, the offsets of its windows that are not the first of their kind.

    ``doc`` and ``pos`` give the documents' order and the segments' places in them.
    """
    size = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(size) - size
    symbols = np.zeros(int(size.sum()), np.int16)
    flat = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    symbols[:] = flat
    symbols += 1
    symbols[begin + size - 1] = 0
    order, rank = run_index(symbols)
    match, _ = matching_statistics(symbols, order, rank)
    owner = np.repeat(np.arange(len(parts)), size)
    offset = np.arange(len(symbols)) - begin[owner]
    window = offset + length < size[owner]
    in_order = order[window[order]]
    fresh_class = match[in_order] < length
    fresh_class[:1] = True
    heads = np.flatnonzero(fresh_class)
    when = (doc[owner[in_order]].astype(np.int64) << 40) + pos[owner[in_order]] + offset[in_order]
    earliest = np.minimum.reduceat(when, heads) if len(heads) else when
    late = in_order[when > earliest[np.cumsum(fresh_class) - 1]]
    late = np.sort(late)
    cut = np.searchsorted(owner[late], np.arange(len(parts) + 1))
    return [offset[late[cut[i]:cut[i + 1]]] for i in range(len(parts))]


def later_windows_by_offset(parts: list[bytes], anchor_at: np.ndarray, doc: np.ndarray, pos: np.ndarray,
                            length: int = LENGTH) -> list[np.ndarray]:
    """The same for segments of one anchor (at ``anchor_at``), an offset to the anchor at a time (the tests compare with it)."""
    out: list[list[int]] = [[] for _ in parts]
    for d in range(int(anchor_at.max()) + 1):
        rows = [i for i, p in enumerate(parts) if 0 <= anchor_at[i] - d and anchor_at[i] - d + length <= len(p)]
        first: dict[bytes, int] = {}
        when = {i: (int(doc[i]), int(pos[i] + anchor_at[i] - d)) for i in rows}
        for i in rows:
            w = parts[i][anchor_at[i] - d: anchor_at[i] - d + length]
            if w not in first or when[i] < when[first[w]]:
                first[w] = i
        for i in rows:
            if first[parts[i][anchor_at[i] - d: anchor_at[i] - d + length]] != i:
                out[i].append(int(anchor_at[i] - d))
    return [np.array(sorted(o), np.int64) for o in out]


def _late_windows(table: pa.Table, length: int) -> pa.Table:
    """A shard of windows: all but the first of their kind as marks."""
    t = table.select(["bytes", "ord", "key", "pos"]).sort_by([(c, "ascending") for c in ("bytes", "ord", "key", "pos")])
    kind = t.column("bytes").combine_chunks().dictionary_encode().indices.to_numpy()
    t = t.filter(pa.array(np.concatenate([[False], kind[1:] == kind[:-1]])))
    pos = t.column("pos").to_numpy().astype("<i8")
    return pa.table({"key": t.column("key"), "marks": pa.array([m.tobytes() for m in np.column_stack([pos, pos + length])], pa.binary())})


def _indexer(shards: int, length: int, block: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("grp")[0].as_py() < 0:
            return pa.table({"key": table.column("key"), "marks": table.column("bytes")})
        if table.column("grp")[0].as_py() >= shards:
            return _late_windows(table, length)
        seg = table.column("bytes").combine_chunks().dictionary_encode()
        code = seg.indices.to_numpy().astype(np.int64)
        ords, pos = table.column("ord").to_numpy(), table.column("pos").to_numpy()
        names = table.column("key").combine_chunks().dictionary_encode()
        name_list = names.dictionary.to_pylist()
        name_rank = np.empty(len(name_list), np.int64)
        name_rank[np.argsort(np.array(name_list))] = np.arange(len(name_list))
        key = name_rank[names.indices.to_numpy()]
        by_rank = [name_list[i] for i in np.argsort(name_rank).tolist()]
        # documents in order: by id, then by key
        order = np.lexsort((pos, key, ords))
        step = np.zeros(len(order), np.int64)
        step[1:] = (ords[order][1:] != ords[order][:-1]) | (key[order][1:] != key[order][:-1])
        doc = np.empty(len(order), np.int64)
        doc[order] = np.cumsum(step)
        marks: dict[str, list[int]] = {}
        # of equal segments all but the first are repeats as they stand
        by_seg = np.lexsort((pos, doc, code))
        first = np.ones(len(by_seg), bool)
        first[1:] = code[by_seg][1:] != code[by_seg][:-1]
        texts = seg.dictionary.to_pylist()
        for r in by_seg[~first].tolist():
            marks.setdefault(by_rank[key[r]], []).extend((int(pos[r]), int(pos[r]) + len(texts[code[r]])))
        rows = by_seg[first]
        anchor = table.column("anchor").to_numpy()
        rows = rows[np.lexsort((pos[rows], doc[rows], anchor[rows]))]
        sizes = np.array([len(texts[c]) + 1 for c in code[rows].tolist()], np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(anchor[rows])) + 1, [len(rows)]])
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(edges) - 1:
            stop = max(at + 1, int(np.searchsorted(total[edges], total[edges[at]] + block, side="right")) - 1)
            mine = rows[edges[at]:edges[stop]]
            at = stop
            if len(mine) < 2:
                continue
            late = later_windows([texts[c] for c in code[mine].tolist()], doc[mine], pos[mine], length)
            for r, offsets in zip(mine.tolist(), late, strict=True):
                if len(offsets):
                    runs = np.split(offsets, np.flatnonzero(np.diff(offsets) > 1) + 1)
                    own = marks.setdefault(by_rank[key[r]], [])
                    for x in runs:
                        own.extend((int(pos[r] + x[0]), int(pos[r] + x[-1]) + length))
        return pa.table({"key": pa.array(list(marks), pa.string()),
                         "marks": pa.array([np.array(m, "<i8").tobytes() for m in marks.values()], pa.binary())})
    return run


# -- results -------------------------------------------------------------------------------------------------

def merged(marks: list[bytes]) -> np.ndarray:
    """Disjoint, sorted ranges (rows of start and end) of a document's marks; touching ranges are one."""
    r = np.concatenate([np.frombuffer(m, "<i8") for m in marks]).reshape(-1, 2) if marks else np.zeros((0, 2), np.int64)
    r = r[np.argsort(r[:, 0], kind="stable")]
    if not len(r):
        return r
    reach = np.maximum.accumulate(r[:, 1])
    begin = np.concatenate([[True], r[1:, 0] > reach[:-1]])
    heads = np.flatnonzero(begin)
    return np.column_stack([r[heads, 0], reach[np.append(heads[1:], len(r)) - 1]])


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text bytes that remain, with the counts."""
    for batch in batches:
        kept, total, removed, spans, starts, ends = [], [], [], [], [], []
        for text, marks in zip(batch.column("text").fill_null(""), batch.column("marks").to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes()
            r = merged(marks or [])
            at, parts = 0, []
            for a, b in r.tolist():
                parts.append(raw[at:a])
                at = b
            parts.append(raw[at:])
            kept.append(b"".join(parts))
            total.append(len(raw))
            removed.append(int((r[:, 1] - r[:, 0]).sum()))
            spans.append(len(r))
            starts.append(r[:, 0].tolist())
            ends.append(r[:, 1].tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(kept, pa.binary()), pa.array(total, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
             pa.array(ends, pa.list_(pa.int64()))],
            names=["doc_id", "key", "kept", "n_bytes", "n_removed", "n_spans", "starts", "ends"])


def _marks(rows: DataFrame, length: int, shard_bytes: int, block: int) -> DataFrame:
    """``key, marks``: lists of marked ranges of every document that has some."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shards_for(size, shard_bytes)
    hot_from = HOT_BLOCKS * block // (2 * length - KGRAM) + 1  # a segment's windows all hold its anchor
    texts = rows.select("key", "ord", "th", F.octet_length("text").alias("n"))
    first = texts.groupBy("th").agg(F.min(F.struct("ord", "key")).alias("first"))
    copies = written(texts.join(first, "th").where((F.col("key") != F.col("first.key")) & (F.col("n") >= length))
                     .select("key", F.col("n").cast("long").alias("n")).distinct(), "repeat-copies")
    anchors = (rows.select("key", "text", "th").mapInArrow(_anchor_packer(shards_for(size, ANCHOR_FACTOR * shard_bytes), length), schema=_ANCHOR_SQL)
               .groupBy("grp").applyInArrow(_repeated_anchors(hot_from), schema=_ANCHOR_SQL)
               .groupBy("batch").applyInArrow(_by_document, schema="key string, anchors binary, hot binary"))
    anchors = written(anchors.dropDuplicates(["key"]).join(copies, "key", "left_anti"), "repeat-anchors")
    # rows of one key are one document, which must not meet itself as a repeat
    cut = (rows.select("key", "doc_id", "text").join(anchors, "key").dropDuplicates(["key"])
           .select(F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), "key", "text", "anchors", "hot")
           .mapInArrow(_cutter(shards, length), schema=_SEG_SQL))
    found = cut.groupBy("grp").applyInArrow(_indexer(shards, length, block), schema=_MARK_SQL)
    whole = copies.select("key", F.unhex(F.concat(F.lit("0" * 16), _little(F.col("n")))).alias("marks"))
    return found.unionByName(whole).groupBy("key").agg(F.collect_list("marks").alias("marks"))


def _little(n: Column) -> Column:
    """A whole number as 8 little-endian bytes, in hexadecimal."""
    big = F.lpad(F.hex(n), 16, "0")
    return F.concat(*[F.substring(big, 15 - 2 * i, 2) for i in range(8)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   shard_bytes: int = SHARD_BYTES, block: int = BLOCK) -> DataFrame:
    """Per row: ``doc_id, key, kept`` (the bytes that remain), ``n_bytes, n_removed, n_spans, starts, ends``.

    ``key`` names the document (a hash of id and text, see ``document_key``).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", document_key(F.col("doc_id"), F.col("text")).alias("key"), "text",
                       F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), F.md5(F.col("text").cast("binary")).alias("th"))
    marks = _marks(rows, length, shard_bytes, block)
    return (rows.select("key", "doc_id", "text").join(marks, "key", "left").select("doc_id", "key", "text", "marks")
            .mapInArrow(_cleaner, schema="doc_id long, key string, kept binary, n_bytes long, n_removed long, "
                                         "n_spans long, starts array<long>, ends array<long>"))


def document_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))).cast("binary"))


def _text_cutter(text_index: int, columns: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for text, marks in zip(batch.column(text_index), batch.column(columns).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid and marks else None
                if raw is not None:
                    left = bytearray(raw)
                    for a, b in merged(marks)[::-1].tolist():
                        del left[a:b]
                texts.append(text.as_py() if raw is None else left.decode("utf-8", "ignore"))
                keep.append(raw is None or bool(left))
            cols = [pa.array(texts, pa.string()) if i == text_index else batch.column(i) for i in range(columns)]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep, pa.bool_()))
    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    shard_bytes: int = SHARD_BYTES, block: int = BLOCK) -> DataFrame:
    """``docs`` with the repeats cut from the texts; documents of which nothing is left go.

    Bytes that no longer form a whole character at a cut are dropped.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", document_key(F.col("doc_id"), F.col("text")).alias("key"), "text",
                       F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), F.md5(F.col("text").cast("binary")).alias("th"))
    k, m = fresh("repeat_key", docs), fresh("repeat_marks", docs)
    marks = _marks(rows, length, shard_bytes, block).select(F.col("key").alias(k), F.col("marks").alias(m))
    names = docs.columns
    own = document_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return (docs.withColumn(k, own).join(marks, k, "left").select(*names, m)
            .mapInArrow(_text_cutter(names.index(text_col), len(names), names), schema=docs.schema))
