"""N-gram Jaccard join with a token-group matrix (operator 6).

A document is the set of its 5-word shingles (64-bit hashes); two link when their
Jaccard similarity is at least 0.8.  The result is exact:

1. *How many documents hold a token.*  A batch of documents sends each of its
   different tokens once to the token's hash shard, with the number of documents
   of the batch that hold it; a token held by a third of all documents is one entry
   per batch.  The shard answers with the tokens that two or more documents hold.
2. *A bound against the whole corpus.*  A link needs 80 % of a document's tokens in
   the other one, so a document with fewer tokens held elsewhere links with nothing.
   Documents with equal sets are one class from here on.
3. *Groups of similar documents.*  In the order (documents that hold a token, token)
   two linked documents share one of their rarest tokens, those that make up the
   last 20 % and one more.  Documents with a common rare token meet in a bucket; each is compared with
   the bucket leader it shares most buckets with.  The components of these links are the groups.
4. *Token-group matrix.*  The union of the members' rare tokens is stored per group.
   For a document and a group that it does not belong to, the overlap with this
   union bounds the overlap with each member (``_least_common``).  Only groups that
   reach the bound are opened, and the members that share a bucket are compared.
5. *Hot buckets.*  Buckets of more than ``HOT_MEMBERS`` members (families of near copies) are no part
   of the matrix: there the union of a group says nothing, as all members hold nearly all of it.
   Their members are written as differences from what most of them hold (``_hot_links``): what two
   documents must have in common in these differences follows from their sizes, and a difference is mostly
   made of tokens that nobody else has, so hardly any pair is compared.

No step lists pairs within a group: members are joined to it by one comparison.

Defined results: null texts, empty texts and texts without words have no shingles
and link with nothing; with fewer than five words the whole sequence is one
shingle; repeated rows link (equal sets); rows without id link others but never
name a component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import shards_for, written
from flightlake.llm.components import components
from flightlake.llm.textkit import SHINGLE, ranges, shingle_hashes, text_blocks

#: Similarity in hundredths, documents of a batch, text bytes per token shard.
PERCENT, BATCH_ROWS, SHARD_BYTES = 80, 4096, 12 << 20
#: Members from which a bucket of several groups is compared by differences.
HOT_MEMBERS = 32
#: Bytes of a hash that travel.
TOKEN_BYTES = 6

_ROW = pa.schema([("grp", pa.int64()), ("batch", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
                  ("c", pa.binary()), ("d", pa.binary())])
_ROW_SQL = "grp long, batch long, kind int, a binary, b binary, c binary, d binary"
_DOC_SQL = "doc_id long, mark long, n_shingles long, set_key binary, tokens array<long>"
HEAD, SHARD = 0, 1


def narrow(tokens: np.ndarray) -> bytes:
    """48-bit tokens as six bytes each."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def widen(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view("<u8").reshape(-1)


def batch_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Tokens of all documents, tokens per document, set sizes, and a key per set.

    Sizes and keys come from the 64-bit hashes, the tokens that travel are their low 48 bits.
    """
    parts, counts, sizes, keys = [np.zeros(0, np.uint64)], [], [], []
    for _, data, bounds in text_blocks(texts):
        h, cut = shingle_hashes(data, bounds, size)
        for i in range(len(bounds) - 1):
            s = np.unique(h[cut[i]:cut[i + 1]])
            sizes.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            parts.append(np.unique(s & np.uint64((1 << 8 * TOKEN_BYTES) - 1)))
            counts.append(len(parts[-1]))
    return np.concatenate(parts), np.array(counts, np.int64), np.array(sizes, np.int64), keys


def _packer(shards: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                yield from _pack(whole.slice(lo, BATCH_ROWS), number, shards, size)
                number += 1
    return run


def _pack(batch: pa.RecordBatch, number: int, shards: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch: its documents (HEAD) and, per shard, its tokens.

    Tokens of one document of the batch go in document order, so that the head only
    needs their numbers; tokens of several documents go once, and the head lists the documents.
    """
    tokens, counts, sizes, keys = batch_sets(batch.column(1), size)
    n_docs = len(counts)
    doc = np.repeat(np.arange(n_docs), counts)
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(first)
    held = np.diff(np.append(at, len(ordered)))
    shared = np.repeat(held > 1, held)
    alone = order[~shared]
    own = (tokens[alone] % np.uint64(shards)).astype(np.int64)
    by_place = np.lexsort((alone, own))  # places are in document order
    alone, own = alone[by_place], own[by_place]
    singles = np.bincount(own * n_docs + doc[alone], minlength=shards * n_docs)
    cut = np.searchsorted(own, np.arange(shards + 1))
    several = ordered[at[held > 1]]
    its_shard = (several % np.uint64(shards)).astype(np.int64)
    by_shard = np.argsort(its_shard, kind="stable")
    several, several_held = several[by_shard], held[held > 1][by_shard]
    several_docs = doc[order[ranges(at[held > 1][by_shard], several_held)]]
    several_cut = np.searchsorted(its_shard[by_shard], np.arange(shards + 1))
    ids = batch.column(0).cast(pa.string()).fill_null("").to_pylist()
    names = "\n".join(f"{i} {m}" for i, m in zip(ids, batch.column(2).to_pylist(), strict=True))
    rows = [(-1 - number, number, HEAD, names.encode(), sizes.astype("<u4").tobytes() + b"".join(keys),
             singles.astype("<u4").tobytes(),
             several_cut.astype("<u4").tobytes() + several_held.astype("<u2").tobytes() + several_docs.astype("<u2").tobytes())]
    for s in range(shards):
        one, many = slice(cut[s], cut[s + 1]), slice(several_cut[s], several_cut[s + 1])
        if cut[s] < cut[s + 1] or several_cut[s] < several_cut[s + 1]:
            rows.append((s, number, SHARD, narrow(tokens[alone[one]]), narrow(several[many]),
                         several_held[many].astype("<u4").tobytes(), b""))
    for lo in range(0, len(rows), 32):
        yield pa.RecordBatch.from_pylist([dict(zip(_ROW.names, r, strict=True)) for r in rows[lo:lo + 32]], schema=_ROW)


def _answer(table: pa.Table) -> pa.Table:
    """A shard: which tokens two or more documents hold, told to every batch that holds them."""
    if table.column("kind")[0].as_py() == HEAD:
        return table
    parts, held = [], []
    for one, many, times in zip(table.column("a"), table.column("b"), table.column("c"), strict=True):
        single, several = widen(one.as_py()), widen(many.as_py())
        parts.append(np.concatenate([single, several]))
        held.append(np.concatenate([np.ones(len(single), np.int64), np.frombuffer(times.as_py(), "<u4")]))
    size = np.cumsum([0] + [len(p) for p in parts])
    tokens, held = np.concatenate(parts), np.concatenate(held)
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    total = np.add.reduceat(held[order], np.flatnonzero(first))
    docs = np.empty(len(tokens), np.int64)
    docs[order] = total[np.cumsum(first) - 1]
    out = []
    for k, batch in enumerate(table.column("batch").to_pylist()):
        part = docs[size[k]:size[k + 1]]
        shared = np.flatnonzero(part >= 2)
        if len(shared):
            out.append((table.column("grp")[0].as_py(), batch, SHARD, shared.astype("<u4").tobytes(), narrow(parts[k][shared]),
                        np.minimum(part[shared], 2**32 - 1).astype("<u4").tobytes(), b""))
    return pa.Table.from_pylist([dict(zip(_ROW.names, r, strict=True)) for r in out], schema=_ROW)


def _owners(head: dict, n_docs: int, replies: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, token and number of documents of every shared token of a batch."""
    singles = np.frombuffer(head["c"], "<u4").astype(np.int64).reshape(-1, n_docs)
    shards = len(singles)
    raw = head["d"]
    cut = np.frombuffer(raw[: 4 * (shards + 1)], "<u4").astype(np.int64)
    several = int(cut[-1])
    held = np.frombuffer(raw[4 * (shards + 1): 4 * (shards + 1) + 2 * several], "<u2").astype(np.int64)
    docs = np.frombuffer(raw[4 * (shards + 1) + 2 * several:], "<u2")
    start = np.cumsum(held) - held
    owner, value, many = [], [], []
    for r in replies:
        s = r["grp"]
        at = np.frombuffer(r["a"], "<u4").astype(np.int64)
        token, total = widen(r["b"]), np.frombuffer(r["c"], "<u4").astype(np.int64)
        ends = np.cumsum(singles[s])
        one = at < ends[-1]
        owner.append(np.searchsorted(ends, at[one], side="right"))
        value.append(token[one])
        many.append(total[one])
        k = cut[s] + at[~one] - ends[-1]
        owner.append(docs[ranges(start[k], held[k])].astype(np.int64))
        value.append(np.repeat(token[~one], held[k]))
        many.append(np.repeat(total[~one], held[k]))
    return np.concatenate(owner), np.concatenate(value), np.concatenate(many)


def _assembler(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """A batch: its documents, with the shared tokens (rarest first) of those that can link."""
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == HEAD)
        replies = [r for r in rows if r["kind"] != HEAD]
        names = [x.split(" ") for x in head["a"].decode().split("\n")]
        ids, marks = [int(x) if x else None for x, _ in names], [int(m) for _, m in names]
        n = np.frombuffer(head["b"][: 4 * len(ids)], "<u4").astype(np.int64)
        keys = [head["b"][4 * len(ids) + 16 * i: 4 * len(ids) + 16 * i + 16] for i in range(len(ids))]
        tokens: list = [None] * len(ids)
        if replies:
            owner, value, docs = _owners(head, len(ids), replies)
            shared = np.bincount(owner, minlength=len(ids))
            able = (n > 0) & (100 * shared >= percent * n)
            pick = able[owner]
            owner, value, docs = owner[pick], value[pick], docs[pick]
            order = np.lexsort((value, docs, owner))
            owner, value = owner[order], value[order]
            bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
            for i in np.flatnonzero(able).tolist():
                tokens[i] = value[bounds[i]:bounds[i + 1]].view(np.int64)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "mark": pa.array(marks, pa.int64()), "n_shingles": pa.array(n), "set_key": pa.array(keys, pa.binary()),
                         "tokens": pa.array(tokens, pa.list_(pa.int64()))})
    return run


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    met = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("t_a", "t_b")))
    return met.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _needed(n: Column, percent: int) -> Column:
    """Least overlap of a document of ``n`` tokens with one that it links with."""
    return F.ceil(n * percent / 100)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row (whole-number ids)."""
    found = _labelled(docs, id_col, text_col, **options)
    return found.select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"))


def _mark(text_col: str) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = PERCENT,
              shard_bytes: int = SHARD_BYTES, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """``doc_id, mark, n_shingles, first`` for every row: the first row, by id and mark, of its component (if that has ids)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       _mark(text_col).alias("mark"))
    shards = shards_for(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, shard_bytes)
    table = written(rows.mapInArrow(_packer(shards, size), schema=_ROW_SQL).groupBy("grp").applyInArrow(
        _answer, schema=_ROW_SQL).groupBy("batch").applyInArrow(_assembler(percent), schema=_DOC_SQL), "jaccard-documents")
    able = table.where(F.col("tokens").isNotNull())
    # equal sets are one class: a row per class with its tokens, and its first row
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    sizes = able.groupBy(F.col("set_key").alias("node")).agg(F.min(row).alias("least"))
    sets = written(able.select(F.col("set_key").alias("node"), F.col("n_shingles").alias("n"), "tokens")
                   .dropDuplicates(["node"]), "jaccard-sets")
    # candidate classes: those with a rare token that another class holds, too
    rare = sets.select("node", "n", F.explode(F.slice(
        "tokens", F.lit(1), F.size("tokens") - _needed(F.col("n"), percent).cast("int") + 1)).alias("token"))
    buckets = rare.groupBy("token").agg(F.count("*").alias("members"), F.min("node").alias("leader"))
    rare = written(rare.join(buckets.where(F.col("members") > 1), "token"), "jaccard-buckets")
    met = (rare.where(F.col("node") != F.col("leader")).groupBy("node", "leader").agg(F.count("*").alias("k"))
           .groupBy("node").agg(F.max_by("leader", F.struct("k", "leader")).alias("leader")))
    links = written(_similar(met.select(F.col("node").alias("a"), F.col("leader").alias("b")), sets, percent),
                    "jaccard-links")
    groups = components(links)
    links = written(links.union(_hot_links(_grouped(rare, groups).where(F.col("members") > hot_members), sets, percent)),
                    "jaccard-links")
    grouped = _grouped(rare.where(F.col("members") <= hot_members), components(links))
    links = links.union(_across(grouped, sets, percent))
    final = components(links)
    label = final.select(F.col("node").alias("set_key"), "label")
    named = (sizes.withColumnRenamed("node", "set_key").join(label, "set_key", "left")
             .withColumn("label", F.coalesce("label", "set_key")))
    least = named.groupBy("label").agg(F.min("least").alias("first"))
    named = named.join(least, "label").select("set_key", "first")
    return table.drop("tokens").join(named, "set_key", "left").select("doc_id", "mark", "n_shingles", "first")


def _least_common(n: Column, other: Column, percent: int) -> Column:
    """Least number of common rare tokens of linked documents of ``n`` and ``other`` tokens.

    Of two documents the one whose rare tokens end earlier in the common order has
    all its common ones among the other's.  It has at most ceil(p n) - 1 tokens behind
    them, and the overlap must reach p / (1 + p) of both sizes.
    """
    overlap = F.ceil((n + other) * percent / (100 + percent))
    return F.greatest(overlap - _needed(F.greatest(n, other), percent) + 1, F.lit(1))


def _grouped(rare: DataFrame, groups: DataFrame) -> DataFrame:
    """The bucket rows with their groups and the groups' sizes, of buckets that hold several groups."""
    sizes = groups.groupBy("label").agg(F.count("*").alias("docs"))
    rows = (rare.join(groups.join(sizes, "label"), "node", "left")
            .select("token", "node", "n", "members", F.coalesce("label", "node").alias("grp"),
                    F.coalesce("docs", F.lit(1)).alias("docs")))
    mixed = rows.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where(F.col("low") != F.col("high"))
    return written(rows.join(mixed.select("token"), "token"), "jaccard-grouped")


def _hot_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of hot buckets (``token, node, n, grp``), enough to join what is linked.

    Buckets with the same first member (``pivot``) are a family.  P are the tokens that more than half of its members
    hold, and D(x) is the symmetric difference of x and P over tokens that travel.  With u tokens of x that no other document holds, q = 100 - percent and s = 100 + percent, let
    E(x) = s (|D(x)| + u(x)) - q |x|.  Then x and y link if and only if 2 s |D(x) & D(y)| >= E(x) + E(y).

    * Where E(x) + E(y) <= 0 they link anyway; then both link with the member of least E, too.  So those
      with E + least E <= 0 are joined to it, and pairs among them need no look.
    * All other pairs have one outside of these, and need common tokens of D: a prefix join over D, the rarest first,
      with least overlaps from the least E that a partner can have, and the places of the common token.
    """
    q, s = 100 - percent, 100 + percent
    pivots = hot.groupBy("token").agg(F.min("node").alias("pivot"))
    met = hot.join(pivots, "token").groupBy("node", "pivot").agg(F.first("grp").alias("grp")).join(sets, "node")
    met = written(met, "jaccard-pivots")
    # all lists together hold twice the members' tokens at most, as each token is in half of its sets
    family = met.groupBy("pivot").agg(F.count("*").alias("members"))
    base = (met.select("pivot", F.explode("tokens").alias("token")).groupBy("pivot", "token").agg(F.count("*").alias("held"))
            .join(family, "pivot").where(2 * F.col("held") > F.col("members"))
            .groupBy("pivot").agg(F.collect_list("token").alias("base")))
    none = F.array().cast("array<long>")
    drawn = (met.join(base, "pivot", "left").withColumn("base", F.coalesce("base", none))
             .withColumn("delta", F.concat(F.array_except("tokens", "base"), F.array_except("base", "tokens")))
             .select("pivot", "node", "grp", "n", "delta", F.size("delta").alias("size"),
                     (s * (F.size("delta") + F.col("n") - F.size("tokens")) - q * F.col("n")).alias("e")))
    drawn = written(drawn, "jaccard-differences")
    least = drawn.groupBy("pivot").agg(F.min(F.struct("e", "node")).alias("_r"), F.max("n").alias("most"))
    drawn = (drawn.join(least, "pivot").withColumns({"low": F.col("_r.e"), "center": F.col("_r.node")}).drop("_r")
             .withColumn("out", F.col("e") + F.col("low") > 0))
    inner = drawn.where(~F.col("out") & (F.col("node") != F.col("center"))).select(F.col("node").alias("a"), F.col("center").alias("b"))
    # least number of common tokens of D: with a partner outside, and of one outside with one inside
    outer = (F.col("e") + F.greatest(F.col("low"), 1 - F.col("low"))) / (2 * s)
    within = F.greatest((F.col("e") + F.col("low")) / (2 * s),
                        (F.col("e") - q * F.least(F.col("n") * 100 / percent, F.col("most"))) / s)
    need = F.when(F.col("out") & (F.col("low") <= 0), F.least(outer, within)).otherwise(outer)
    drawn = drawn.withColumn("first", F.col("size") - F.greatest(F.ceil(need - 1e-9), F.lit(1)) + 1).where(F.col("first") > 0)
    drawn = drawn.join(drawn.where("out").select("pivot").distinct(), "pivot", "left_semi")
    tokens = written(drawn.select("pivot", "node", "grp", "n", "size", "e", "out", "first", F.explode("delta").alias("token")),
                     "jaccard-difference-tokens")
    held = tokens.groupBy("pivot", "token").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    by = ["pivot", "node", "grp", "n", "size", "e", "out", "first"]
    ordered = (tokens.join(held, ["pivot", "token"]).groupBy(*by)
               .agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("_t"))  # a document's own difference
               .withColumn("alone", F.col("size") - F.size("_t")))  # tokens that no other one has come first
    prefix = (ordered.where(F.col("first") > F.col("alone"))
              .select(*by, "alone", F.posexplode(F.slice("_t", F.lit(1), (F.col("first") - F.col("alone")).cast("int"))).alias("at", "_x"))
              .select("pivot", F.col("_x.token").alias("token"), "node", "grp", "n", "e", "out",
                      (2 * s * (F.col("size") - F.col("alone") - F.col("at"))).alias("left")))
    prefix = written(prefix, "jaccard-difference-prefixes")
    x = prefix.where("out").select("pivot", "token", *[F.col(c).alias(f"{c}_x") for c in ("node", "grp", "n", "e", "left")])
    y = prefix.select("pivot", "token", *[F.col(c).alias(f"{c}_y") for c in ("node", "grp", "n", "e", "left", "out")])
    reach = F.col("e_x") + F.col("e_y")
    pairs = (x.join(y, ["pivot", "token"])
             .where((F.col("grp_x") != F.col("grp_y")) & (~F.col("out_y") | (F.col("node_x") < F.col("node_y")))
                    & (F.col("left_x") >= reach) & (F.col("left_y") >= reach)
                    & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")))
             .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct())
    return inner.union(_similar(pairs, sets, percent))


def _across(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents of different groups: bound by token unions, then open the groups that qualify."""
    here = grouped.select("token", "node", "n", "grp", "docs")
    # the matrix: rare tokens of each group, with the sizes of the members that hold them
    matrix = here.groupBy("token", F.col("grp").alias("other")).agg(F.min("n").alias("low"), F.max("n").alias("high"),
                                                                    F.first("docs").alias("other_docs"))
    # a pair is met once: documents of the smaller group ask the larger one
    smaller = F.struct("docs", "grp") < F.struct(F.col("other_docs").alias("docs"), F.col("other").alias("grp"))
    met = (here.join(matrix, "token").where(smaller
                                            & (100 * F.col("high") >= percent * F.col("n"))
                                            & (percent * F.col("low") <= 100 * F.col("n")))
           .groupBy("node", "n", "other").agg(F.count("*").alias("both"), F.min("low").alias("low"), F.max("high").alias("high")))
    # sizes that can link lie between p n and n / p; without rounding the bound is least at an end of the range
    low = F.greatest(F.col("low"), F.ceil(F.col("n") * percent / 100))
    high = F.least(F.col("high"), F.floor(F.col("n") * 100 / percent))
    more_than = [(F.col("n") + x) * percent / (100 + percent) - F.greatest(F.col("n"), x) * percent / 100 for x in (low, high)]
    opened = written(met.where(F.col("both") > F.least(*more_than) - 1e-6).select("node", "other"), "jaccard-opened")
    left = here.select("token", F.col("node").alias("a"), F.col("n").alias("n_a")).join(
        opened.withColumnRenamed("node", "a"), "a")
    right = here.select("token", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("grp").alias("other"))
    pairs = (left.join(right, ["token", "other"])
             .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
             .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                      F.least("n_a", "n_b").alias("n_low"), F.greatest("n_a", "n_b").alias("n_high"))
             .agg(F.count_distinct("token").alias("both"))
             .where(F.col("both") >= _least_common(F.col("n_low"), F.col("n_high"), percent)).select("a", "b"))
    return written(_similar(pairs, sets, percent), "jaccard-links-across")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    Rows of one id with different texts are rows of their own (the order among them is that of a hash of the
    text); of rows with equal id and text one stays; rows without id stay (they cannot name a component).
    """
    found = written(_labelled(docs, id_col, text_col, **options).where(F.col("doc_id").isNotNull()), "jaccard-labelled")
    row = F.struct("doc_id", "mark")
    gone = found.where(row != F.col("first")).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_text")).distinct()
    # rows that are repeated as a whole are few: only they are compared
    again = (found.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_text")).agg(F.count("*").alias("rows"))
             .where("rows > 1").select("_id", "_text"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("_id"),
                         _mark(text_col).alias("_text"))
    kept = marked.join(gone, ["_id", "_text"], "left_anti")
    again = written(again, "jaccard-repeated-rows")
    once = kept.join(again, ["_id", "_text"], "left_anti")
    repeated = kept.join(again, ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"])
    return once.select("row.*").unionByName(repeated.select("row.*"))
