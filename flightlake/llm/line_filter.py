"""Line deduplication with two Bloom filters (operator 13).

A line's key is the line without ASCII white space at its ends, with A-Z in lower
case.  A key of at least ``least_chars`` code points that ``least_docs`` documents
hold is common: its lines go from all of these documents but one, that with the
largest id (``keep="last"``) or the smallest (``keep="first"``).

1. *Two filters.*  Lines are known by a 64-bit hash, whose upper half names a shard.
   A batch of documents sends each different hash once, as the lower four bytes with
   the documents' places in the batch.  A shard folds them into a filter of hashes
   seen once and one of hashes seen twice (in the first already, or held by two
   documents of one batch); both have a fixed size.  Then all hashes of the shard are
   tested: those in the second filter go back to their batch, as suspected repeats.
   Filters forget nothing, so no repeat is missed; a false alarm costs one row of step 2.
2. *Exact confirmation.*  Documents meet their suspected hashes, and only those lines
   send a 128-bit digest of the whole key, with the id.  Different documents are
   counted per digest, and the largest (or smallest) id is chosen, with partial
   aggregation, so that a line of a third of all documents is a row per task.
3. *Removal.*  The digests of common lines go back to the documents that lose them.
   Texts are shuffled once for each of steps 2 and 3, whatever the number of repeats.

Defined results: a null or empty text has one empty line; rows without id are one
document that comes before all others; rows that share an id are one document, and
the one that keeps a key keeps all its lines; rows repeated as a whole stay; a text of
which no line is left is empty; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import shards_for, written
from flightlake.llm.textkit import mix

#: Code points of a key and documents that hold it, from which a line is common.
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Documents of a batch, text bytes of a shard, hashes folded at a time.
BATCH_ROWS, SHARD_BYTES, FOLDED = 4096, 64 << 20, 1 << 17
#: Places of a filter, a power of two: lines of 20 bytes, the shortest, fill a fifth of them a hash function.
FILTER_SIZE = 1 << 24
#: Fixed value: the white space of a key's ends.
SPACE = b" \t\n\x0b\x0c\r"

_ROW = pa.schema([("grp", pa.int64()), ("batch", pa.int64()), ("head", pa.bool_()), ("hashes", pa.binary()),
                  ("held", pa.binary()), ("docs", pa.binary())])
_ROW_SQL = "grp long, batch long, head boolean, hashes binary, held binary, docs binary"


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The key of a line, or None where it has fewer code points."""
    key = line.strip(SPACE).lower()
    if len(key) < least_chars:
        return None
    if len(key) >= 4 * least_chars or key.isascii() or len(key.decode()) >= least_chars:
        return key
    return None


def line_hashes(text: bytes, least_chars: int, shards: int) -> list[int]:
    """Shard and lower half of the hash of every line with a key, as one number."""
    out = []
    for line in text.split(b"\n"):
        key = line_key(line, least_chars)
        if key is not None:
            h = xxhash.xxh3_64_intdigest(key)
            out.append(((h >> 32) % shards) << 32 | h & 0xFFFFFFFF)
    return out


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _packer(shards: int, least_chars: int):
    """Rows of a batch: the keys of its rows (head) and, per shard, its different hashes and who holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                part = whole.slice(lo, BATCH_ROWS)
                rows = _pack(part, number, shards, least_chars)
                for k in range(0, len(rows), 1024):
                    yield pa.RecordBatch.from_pylist([dict(zip(_ROW.names, r, strict=True)) for r in rows[k:k + 1024]],
                                                     schema=_ROW)
                number += 1
    return run


def _pack(part: pa.RecordBatch, number: int, shards: int, least_chars: int) -> list[tuple]:
    found, counts = [], []
    for text in part.column(0).cast(pa.binary()).to_pylist():
        mine = set(line_hashes(text, least_chars, shards))
        found.extend(mine)
        counts.append(len(mine))
    ids, marks = (part.column(i).to_numpy(zero_copy_only=False).astype("<i8") for i in (1, 2))
    rows = [(-1 - number, number, True, ids.tobytes(), b"", marks.tobytes())]
    value = np.array(found, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts).astype("<u2")
    order = np.argsort(value, kind="stable")
    value, doc = value[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    held, own = np.diff(np.append(first, len(value))), value[first] >> 32
    for lo, hi in zip(*(lambda c: (c[:-1], c[1:]))(np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))), strict=True):
        stop = first[hi] if hi < len(first) else len(value)
        rows.append((int(own[lo]), number, False, (value[first[lo:hi]] & 0xFFFFFFFF).astype("<u4").tobytes(),
                     held[lo:hi].astype("<u2").tobytes(), doc[first[lo]:stop].tobytes()))
    return rows


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in a filter."""
    other = mix(hashes.astype(np.uint64) + np.uint64(1))
    return hashes & np.uint32(FILTER_SIZE - 1), (other & np.uint64(FILTER_SIZE - 1)).astype(np.int64)


def twice_seen(hashes: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Whether the filter of twice-seen hashes holds each of ``hashes``; ``several`` marks those that count twice."""
    once, twice = np.zeros(FILTER_SIZE, bool), np.zeros(FILTER_SIZE, bool)
    for lo in range(0, len(hashes), FOLDED):
        part, at, count = np.unique(hashes[lo:lo + FOLDED], return_index=True, return_counts=True)
        a, b = _places(part)
        again = (once[a] & once[b]) | (count > 1) | several[lo + at]
        once[a] = once[b] = True
        twice[a[again]] = twice[b[again]] = True
    out = np.zeros(len(hashes), bool)
    for lo in range(0, len(hashes), FOLDED):
        a, b = _places(hashes[lo:lo + FOLDED])
        out[lo:lo + FOLDED] = twice[a] & twice[b]
    return out


def _suspects(table: pa.Table) -> pa.Table:
    """A shard: its suspected repeats, told to the batches that hold them."""
    if table.column("head")[0].as_py():
        return table
    hashes = [np.frombuffer(x.as_py(), "<u4") for x in table.column("hashes")]
    held = [np.frombuffer(x.as_py(), "<u2") for x in table.column("held")]
    size = np.cumsum([0] + [len(h) for h in hashes])
    seen = twice_seen(np.concatenate(hashes), np.concatenate(held) > 1)
    out = []
    for k, (batch, docs) in enumerate(zip(table.column("batch").to_pylist(), table.column("docs"), strict=True)):
        hit = seen[size[k]:size[k + 1]]
        if hit.any():
            where = np.frombuffer(docs.as_py(), "<u2")[np.repeat(hit, held[k])]
            out.append((table.column("grp")[0].as_py(), batch, False, hashes[k][hit].tobytes(), held[k][hit].tobytes(),
                        where.tobytes()))
    return pa.Table.from_pylist([dict(zip(_ROW.names, r, strict=True)) for r in out], schema=_ROW)


def _by_row(table: pa.Table) -> pa.Table:
    """A batch: the suspected hashes of each of its rows."""
    ids = marks = None
    value, doc = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r in table.to_pylist():
        if r["head"]:
            ids, marks = np.frombuffer(r["hashes"], "<i8"), np.frombuffer(r["docs"], "<i8")
        else:
            held = np.frombuffer(r["held"], "<u2")
            value.append(np.repeat(r["grp"] << 32 | np.frombuffer(r["hashes"], "<u4").astype(np.int64), held))
            doc.append(np.frombuffer(r["docs"], "<u2").astype(np.int64))
    v, d = np.concatenate(value), np.concatenate(doc)
    order = np.argsort(d, kind="stable")
    v, d = v[order], d[order]
    rows = np.unique(d)
    cut = np.searchsorted(d, np.append(rows, len(ids)))
    blobs = [v[lo:hi].tobytes() for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table({"_id": pa.array(ids[rows], pa.int64()), "_mark": pa.array(marks[rows], pa.int64()),
                     "suspects": pa.array(blobs, pa.binary())})


def _digests(shards: int, least_chars: int):
    """The digests of the suspected lines of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, at = [], []
            texts = batch.column(0).cast(pa.binary())
            for i, (text, blob) in enumerate(zip(texts, batch.column(1), strict=True)):
                wanted = set(np.frombuffer(blob.as_py(), "<i8").tolist())
                mine = set()
                for line in text.as_py().split(b"\n"):
                    key = line_key(line, least_chars)
                    if key is not None and line_hashes(key, least_chars, shards)[0] in wanted:
                        mine.add(_digest(key))
                digests.extend(mine)
                at.extend([i] * len(mine))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *(batch.column(i).take(at) for i in (2, 3, 4))],
                                             names=["digest", "_doc", "_id", "_mark"])
    return run


def _without(least_chars: int):
    """Texts without the lines whose digests ``drops`` lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept = [], [], []
            for text, drops in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                text = text.as_py()
                lines.append(text.count(b"\n") + 1)
                if drops:
                    gone, stay = set(drops), []
                    for line in text.split(b"\n"):
                        key = line_key(line, least_chars)
                        if key is None or _digest(key) not in gone:
                            stay.append(line)
                    dropped.append(lines[-1] - len(stay))
                    text = b"\n".join(stay)
                else:
                    dropped.append(0)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept"])
    return run


def remove_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                        least_docs: int = LEAST_DOCS, keep: str = "last", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the remaining text) for every row (whole-number ids).

    ``least_docs`` is at least 2: the filters tell once from twice, the confirmation counts on.
    """
    if least_docs < 2 or keep not in ("first", "last"):
        raise ValueError("least_docs must be 2 or more, keep 'first' or 'last'")
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("_doc"))
    rows = rows.select("text", "_doc", F.coalesce("_doc", F.lit(0)).cast("long").alias("_id"),
                       F.xxhash64(F.col("_doc").isNull(), "text").alias("_mark"))  # _id and _mark name a row
    shards = shards_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, shard_bytes)
    told = (rows.select("text", "_id", "_mark").mapInArrow(_packer(shards, least_chars), schema=_ROW_SQL)
            .groupBy("grp").applyInArrow(_suspects, schema=_ROW_SQL))
    suspects = written(told.groupBy("batch").applyInArrow(_by_row, schema="_id long, _mark long, suspects binary"),
                       "line-suspects").dropDuplicates(["_id", "_mark"])
    lines = (rows.join(suspects, ["_id", "_mark"]).select("text", "suspects", "_doc", "_id", "_mark")
             .mapInArrow(_digests(shards, least_chars), schema="digest binary, _doc long, _id long, _mark long"))
    lines = written(lines, "line-digests")
    chosen = (F.max if keep == "last" else F.min)(F.struct(F.col("_doc").isNotNull(), "_doc") if keep == "first" else F.col("_doc"))
    common = (lines.select("digest", "_doc").distinct().groupBy("digest")
              .agg(F.count("*").alias("documents"), chosen.alias("chosen")).where(F.col("documents") >= least_docs))
    stays = F.col("chosen._doc") if keep == "first" else F.col("chosen")
    drops = (lines.join(common, "digest").where(~F.col("_doc").eqNullSafe(stays))
             .groupBy("_id", "_mark").agg(F.collect_set("digest").alias("drops")))  # at most a document's lines
    met = rows.join(drops, ["_id", "_mark"], "left").select("text", "drops", "_doc")
    return met.mapInArrow(_without(least_chars), schema="doc_id long, n_lines long, n_dropped long, kept string")
