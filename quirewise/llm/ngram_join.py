"""Operator 1: n-gram Jaccard join by MinHash LSH, with exact verification.

Documents are sets of shingles of five words; those of resemblance 0.8 or more are linked.

1. Equal texts are one node with a number of copies, so a group of copies costs one row from here on.
2. A node has a label of `depth` MinHash components in each of `trees` prefix tries. It starts at its whole label in every
   trie and shortens it trie by trie: first to the least length wherever the prefix's nodes fit one unit, then, of its hot
   prefixes, whichever gains the fewest nodes, until a pair at the threshold meets it with probability `recall`. So a hot
   prefix is left long where the node's other tries make up for it. (Cold prefixes are shortened by their size alone, never
   by whom they hold, so the choice tells nothing of a pair and the estimate holds.) Two nodes are candidates in a trie if
   they agree on the shorter of their two prefixes there: a node is active at its own length and passive at lesser ones.
   The least length is that which reaches `recall` if all tries use it; sorting by prefix hash stands for walking the trie.
3. A prefix's active nodes are dealt into blocks of about `block` nodes and `BYTES` of text, its passive ones too, and each
   pair of blocks with an active one is a unit, so no task gets a whole hot prefix, and no pair is a row. In a unit a pair
   is looked at only if this is the first trie in which it meets, and goes on only if its share of equal components isn't
   4.5 standard errors below the threshold. Nodes without such a pair leave the unit.
4. The rest get their texts, and each unit counts shared shingles of its pairs exactly: by a product of 0/1 matrices, a
   few thousand shingles at a time. It returns each node's number of links and its least node among those it is tied to.
5. Links of a node are summed over units; ties give connected components (alternating stars, written each round).

Results in special cases: a text of 1 to 4 words has one shingle, all its words; a null or empty text has none and no
links, and is a class of its own; equal rows are copies; a null id counts as the least one; rows with equal ids and other
texts count as one document, which has the links of all; columns other than the two named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .components import components
from .kernels import U64

THRESHOLD = 0.8
SIZE = 5
TREES = 16
DEPTH = 6
RECALL = 0.999
BLOCK = 256
BYTES = 4 << 20
COLUMNS = 4096
LEAST_ID = -(2**63)
UNIT = ["unit", "tree", "length", "side", "cross", "node", "text_hash", "copies", "signature", "lengths"]


def prefix_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability `recall`; at least 1."""
    d = depth
    while d > 1 and 1 - (1 - threshold**d) ** trees < recall:
        d -= 1
    return d


def signatures(trees: int, depth: int, size: int):
    factors = kernels.mixed(np.arange(1, trees * depth + 1, dtype=U64) * U64(kernels.PAIR_BASE)) | U64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.rebatched(batches, most=2 << 20):
            own, hashes = kernels.Words(batch["text"]).shingles(size)
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out = np.zeros((len(batch), trees * depth), np.uint16)
            if len(first):
                for k, f in enumerate(factors):
                    least = np.minimum.reduceat(hashes * f, first)
                    out[own[first], k] = (kernels.mixed(least) & U64(0xFFFF)).astype(np.uint16)
            some = np.zeros(len(batch), bool)
            some[own[first]] = True
            raw = out.tobytes()
            width = trees * depth * 2
            column = pa.array([raw[i * width : (i + 1) * width] if s else None for i, s in enumerate(some.tolist())], pa.binary())
            size_of = pc.binary_length(batch["text"]).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["text_hash"], batch["text_hash_2"], size_of, column], names=["doc", "text_hash", "text_hash_2", "bytes", "signature"])

    return sign


def shortening(trees: int, depth: int, least: int, threshold: float, recall: float):
    """Of each node in hot prefixes: how long its prefix is in each trie, as a column `lengths` of bytes in its first row and
    as `own`, that of the row's trie. Tries without a row are not hot and have the least length."""
    missed = np.log1p(-np.minimum(threshold ** np.arange(1, depth + 1), 1 - 1e-12))  # by length - 1
    bound = math.log1p(-recall)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in kernels.whole_groups(batches, "key"):
            node = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            tree = table["tree"].to_numpy()
            gains = np.zeros((len(bounds) - 1, trees, depth + 1))  # nodes gained by going from length d + 1 to d
            for d in range(least, depth):
                gains[node, tree, d] = table[f"n{d}"].to_numpy() - table[f"n{d + 1}"].to_numpy()
            lengths = np.full((len(bounds) - 1, trees), least)
            lengths[node, tree] = depth
            while True:
                can = lengths > least
                low = np.flatnonzero((missed[lengths - 1].sum(1) > bound) & can.any(1))
                if not len(low):
                    break
                gain = np.take_along_axis(gains[low], np.maximum(lengths[low] - 1, 0)[:, :, None], 2)[:, :, 0]
                lengths[low, np.where(can[low], gain, np.inf).argmin(1)] -= 1
            first = np.zeros(len(table), bool)
            first[bounds[:-1]] = True
            raw = [lengths[n].astype(np.uint8).tobytes() if f else None for n, f in zip(node.tolist(), first.tolist())]
            out = table.select(["node", "text_hash", "tree", "label", "bytes"])
            out = out.append_column("own", pa.array(lengths[node, tree].astype(np.int32))).append_column("lengths", pa.array(raw, pa.binary()))
            yield from out.combine_chunks().to_batches()

    return choose


def candidates(sig: np.ndarray, lengths: np.ndarray, side: np.ndarray, both: bool, tree: int, length: int, cut: float) -> np.ndarray:
    """Which pairs of a unit's nodes are to be verified: a matrix of truth above the diagonal."""
    n, depth = len(sig), sig.shape[1] // lengths.shape[1]
    equal = np.zeros((n, n), np.int16)
    for column in sig.T:
        equal += column[:, None] == column[None, :]
    out = equal >= cut * sig.shape[1]
    out &= np.triu(np.ones((n, n), bool), 1)
    if both:
        out &= side[:, None] != side[None, :]
    active = lengths[:, tree] == length
    out &= active[:, None] | active[None, :]
    for t in range(tree):
        if not out.any():
            break
        need = np.minimum(lengths[:, t][:, None], lengths[:, t][None, :])
        met = np.ones((n, n), bool)
        for c in range(depth):
            column = sig[:, t * depth + c]
            met &= (column[:, None] == column[None, :]) | (need <= c)
        out &= ~met
    return out


def matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def sieve(trees: int, depth: int, cut: float):
    """Keeps the rows of a unit that have a pair to be verified."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in kernels.whole_groups(batches, "unit"):
            sig, lengths = matrix(table["signature"], trees * depth, np.uint16), matrix(table["lengths"], trees, np.uint8)
            tree, length, side, cross = (table[c].to_numpy() for c in ("tree", "length", "side", "cross"))
            kept = np.zeros(len(table), bool)
            sizes = np.diff(bounds)
            low = bounds[:-1][sizes == 2]  # most units: two nodes, all at once
            if len(low):
                equal = sig[low] == sig[low + 1]
                good = (equal.mean(1) >= cut) & ~(cross[low] & (side[low] == side[low + 1]))
                need = np.minimum(lengths[low], lengths[low + 1])
                met = np.logical_and.accumulate(equal.reshape(len(low), trees, depth), 2).sum(2) >= need
                good &= np.where(met.any(1), met.argmax(1), trees) == tree[low]
                good &= need[np.arange(len(low)), tree[low]] == length[low]
                kept[low[good]] = kept[low[good] + 1] = True
            for a, b in zip(bounds[:-1][sizes > 2].tolist(), bounds[1:][sizes > 2].tolist()):
                pairs = candidates(sig[a:b], lengths[a:b], side[a:b], bool(cross[a]), int(tree[a]), int(length[a]), cut)
                kept[a:b] = pairs.any(0) | pairs.any(1)
            if kept.any():
                yield from table.filter(pa.array(kept)).select(UNIT).combine_chunks().to_batches()

    return keep


def shared_counts(own: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct shingles of each text, and of those that two texts share, for all pairs."""
    order = np.lexsort((own, hashes))
    own, hashes = own[order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
    own, hashes = own[new], hashes[new]
    sizes = np.bincount(own, minlength=n)
    head = np.ones(len(own), bool)
    head[1:] = hashes[1:] != hashes[:-1]
    code = np.cumsum(head) - 1
    often = np.bincount(code)[code] > 1
    own, code = own[often], code[often]
    code = np.cumsum(np.diff(code, prepend=-1) != 0) - 1
    shared = np.zeros((n, n), np.float32)
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
        part = slice(*np.searchsorted(code, [low, low + COLUMNS]))
        ones = np.zeros((n, int(code[part][-1]) - low + 1), np.float32)
        ones[own[part], code[part] - low] = 1
        shared += ones @ ones.T
    return sizes, shared.astype(np.int64)


def verify(trees: int, depth: int, cut: float, threshold: float, size: int):
    """Of each node of a unit: its links to others there, as texts and as documents, and the least node of those it is tied to."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in kernels.whole_groups(batches, "unit"):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                part = table.slice(a, b - a)
                key = np.stack([part["node"].to_numpy(), part["text_hash"].to_numpy()])  # repeated rows of one document follow each other
                part = part.filter(pa.array(np.append(True, (key[:, 1:] != key[:, :-1]).any(0))))
                n = len(part)
                node, copies, side = (part[c].to_numpy() for c in ("node", "copies", "side"))
                sig, lengths = matrix(part["signature"], trees * depth, np.uint16), matrix(part["lengths"], trees, np.uint8)
                pairs = candidates(sig, lengths, side, part["cross"][0].as_py(), part["tree"][0].as_py(), part["length"][0].as_py(), cut)
                sizes, shared = shared_counts(*kernels.Words(part["text"]).shingles(size), n)
                union = sizes[:, None] + sizes[None, :] - shared
                linked = pairs & (shared >= threshold * union - 1e-9)
                linked |= linked.T
                has = np.flatnonzero(linked.any(1))
                if not len(has):
                    continue
                tie = node.copy()
                while True:
                    low = np.where(linked, tie[None, :], np.iinfo(np.int64).max).min(1)
                    low = np.minimum(tie, low)
                    if (low == tie).all():
                        break
                    tie = low
                out = [node[has], tie[has], linked.sum(1)[has], (linked * copies[None, :]).sum(1)[has]]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["node", "tie", "texts", "docs"])

    return links


def tries(nodes: DataFrame, trees: int, depth: int, least: int, threshold: float, recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Where each node stands: (prefix, tree, length, active, node, text_hash, n_active, n_passive, with their bytes), and the
    lengths of those that stand in hot prefixes. Prefixes of one node are left out."""

    def label(t):
        return F.col("signature").substr(t * (2 * depth) + 1, F.lit(2 * depth))

    def prefix(length):
        return F.xxhash64("tree", F.lit(length), F.expr(f"substring(label, 1, {2 * length})"))

    shared = nodes.select("node", "text_hash", "bytes", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), label)).alias("tree", "label"))
    shared = shared.select("node", "text_hash", "bytes", "tree", prefix(least).alias("prefix"))
    sizes = shared.groupBy(F.col("prefix").alias("_prefix")).agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).where("n > 1")
    shared = kernels.written(shared.drop("bytes").join(sizes, F.col("prefix") == F.col("_prefix")).drop("_prefix"), "shared")
    cold = (F.col("n") <= block) & (F.col("b") <= BYTES)
    one = F.lit(0).cast("long")
    whole = shared.where(cold).select("prefix", "tree", F.lit(least).alias("length"), F.lit(True).alias("active"), "node", "text_hash", F.col("n").alias("n_active"), F.col("b").alias("b_active"), one.alias("n_passive"), one.alias("b_passive"))
    signed = nodes.select(F.col("node").alias("_node"), F.col("text_hash").alias("_hash"), "bytes", "signature")
    hot = shared.where(~cold).drop("prefix", "b").withColumnRenamed("n", f"n{least}")
    hot = hot.join(signed, (F.col("node") == F.col("_node")) & (F.col("text_hash") == F.col("_hash"))).withColumn("label", label(F.col("tree"))).drop("_node", "_hash", "signature")
    if depth > least:
        hot = kernels.written(hot, "hot")
    for length in range(least + 1, depth + 1):
        sizes = hot.groupBy(prefix(length).alias("_prefix")).agg(F.count("*").alias("_n")).where("_n > 1")
        hot = hot.join(sizes, prefix(length) == F.col("_prefix"), "left").withColumn(f"n{length}", F.coalesce("_n", F.lit(1))).drop("_prefix", "_n")
    hot = hot.withColumn("key", F.xxhash64("node", "text_hash")).repartition("key").sortWithinPartitions("key", "tree")
    chosen = kernels.written(hot.mapInArrow(shortening(trees, depth, least, threshold, recall), "node long, text_hash long, tree int, label binary, bytes long, own int, lengths binary"), "chosen")
    lengths = chosen.where("lengths is not null").select(F.col("node").alias("_node"), F.col("text_hash").alias("_hash"), "lengths")
    stands = chosen.withColumn("length", F.explode(F.sequence(F.lit(least), "own"))).withColumn("active", F.col("length") == F.col("own"))
    stands = stands.withColumn("prefix", F.xxhash64("tree", "length", F.expr("substring(label, 1, 2 * length)")))
    of = lambda what, c: F.sum(F.when(F.col("active") == what, F.col(c) if c else F.lit(1)).otherwise(0))
    buckets = stands.groupBy(F.col("prefix").alias("_prefix")).agg(of(True, None).alias("n_active"), of(True, "bytes").alias("b_active"), of(False, None).alias("n_passive"), of(False, "bytes").alias("b_passive"))
    buckets = buckets.where("n_active > 0 and n_active + n_passive > 1")
    return whole.unionByName(stands.join(buckets, F.col("prefix") == F.col("_prefix")).select(*whole.columns)), lengths


def dealt(members: DataFrame, block: int) -> DataFrame:
    """The units in which a node stands: pairs of blocks of its prefix, of which one at least holds active nodes."""
    blocks = lambda n, b: F.greatest(F.ceil(F.col(n) / block), F.ceil(F.col(b) / BYTES)).cast("int")
    fits = (F.col("n_active") + F.col("n_passive") <= block) & (F.col("b_active") + F.col("b_passive") <= BYTES)
    x = members.withColumn("_first", F.when(fits, 1).otherwise(F.greatest(blocks("n_active", "b_active"), F.lit(1))))
    x = x.withColumn("_second", F.when(fits, 0).otherwise(blocks("n_passive", "b_passive")))
    at = F.xxhash64("node", "text_hash", "tree")
    x = x.withColumn("_own", F.when(F.col("active") | (F.col("_second") == 0), F.pmod(at, F.col("_first"))).otherwise(F.col("_first") + F.pmod(at, F.greatest("_second", F.lit(1)))).cast("int"))
    x = x.withColumn("_other", F.explode(F.sequence(F.lit(0), F.when(F.col("_own") < F.col("_first"), F.col("_first") + F.col("_second") - 1).otherwise(F.col("_first") - 1))))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return x.select(F.xxhash64("prefix", low, high).alias("unit"), "tree", "length", (F.col("_own") == low).alias("side"), (low != high).alias("cross"), "node", "text_hash")


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, size: int = SIZE, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row for each row of docs: id, class_id (least id of its group of linked documents), copy_id (least id with
    the same text), n_links (other documents linked to it, copies included), n_text_links (other texts linked to it)."""
    least = prefix_depth(threshold, trees, depth, recall)
    cut = threshold - 4.5 * math.sqrt(threshold * (1 - threshold) / (trees * depth))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LEAST_ID)).alias("doc"), F.xxhash64(body).alias("text_hash"), F.hash(body).alias("text_hash_2"), body.alias("text"))
    signed = kernels.written(rows.mapInArrow(signatures(trees, depth, size), "doc long, text_hash long, text_hash_2 int, bytes long, signature binary"), "signatures")
    nodes = signed.where("signature is not null").groupBy("text_hash", "text_hash_2").agg(F.min(F.struct("doc", "signature")).alias("x"), F.count("*").alias("copies"), F.max("bytes").alias("bytes"))
    nodes = kernels.written(nodes.select(F.col("x.doc").alias("node"), "text_hash", "text_hash_2", "copies", "bytes", F.col("x.signature").alias("signature")), "nodes")

    members, lengths = tries(nodes, trees, depth, least, threshold, recall, block)
    known = nodes.join(lengths, (F.col("node") == F.col("_node")) & (F.col("text_hash") == F.col("_hash")), "left").drop("_node", "_hash")
    known = known.withColumn("lengths", F.coalesce("lengths", F.lit(bytes([least]) * trees)))
    units = dealt(members, block).withColumnsRenamed({"node": "_node", "text_hash": "_hash"})
    units = units.join(known, (F.col("_node") == F.col("node")) & (F.col("_hash") == F.col("text_hash"))).select(*UNIT)
    kept = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(sieve(trees, depth, cut), units.schema)
    texts = rows.select("doc", F.col("text_hash").alias("_hash"), "text")
    kept = kept.join(texts, (F.col("node") == F.col("doc")) & (F.col("text_hash") == F.col("_hash"))).drop("doc", "_hash")
    found = kept.repartition("unit").sortWithinPartitions("unit", "node", "text_hash").mapInArrow(verify(trees, depth, cut, threshold, size), "node long, tie long, texts long, docs long")
    found = kernels.written(found, "links")
    totals = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs")).withColumnRenamed("node", "_linked")
    roots = components(found.select(F.col("node").alias("a"), F.col("tie").alias("b"))).withColumnRenamed("node", "_rooted")
    known = nodes.join(totals, F.col("node") == F.col("_linked"), "left").join(roots, F.col("node") == F.col("_rooted"), "left")
    known = known.select(F.col("text_hash").alias("_h1"), F.col("text_hash_2").alias("_h2"), "node", F.coalesce("root", "node").alias("root"), "copies", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"))
    out = signed.select("doc", "text_hash", "text_hash_2", F.col("signature").isNotNull().alias("some"))
    out = out.join(known, F.col("some") & (F.col("text_hash") == F.col("_h1")) & (F.col("text_hash_2") == F.col("_h2")), "left")
    shown = lambda c: F.when(c != LEAST_ID, c)
    return out.select(
        shown(F.col("doc")).alias(id_column),
        shown(F.coalesce("root", "doc")).alias("class_id"),
        shown(F.coalesce("node", "doc")).alias("copy_id"),
        F.coalesce(F.col("docs") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )
