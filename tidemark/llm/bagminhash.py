"""Near-dedup of word-shingle multisets by BagMinHash, banding and exact overlap.

A text is the multiset of its five-word shingles. Each (shingle, weight unit) pair owns
a Poisson process of points that fall on random registers; a register keeps its
earliest point. The units of a shingle's weight are covered by the dyadic ranges
(0,1], (1,2], (2,4], ...; a range is one process of the range's rate, whose points go
left or right by the bits of a hash until they reach a unit, and points beyond the
weight are dropped. Two texts agree in a register with probability equal to their
weighted Jaccard similarity, and points later than every register are never drawn.

Equal texts are one node. Nodes that share a band's registers meet in a bucket; each is
held against the bucket's two hubs (the first node, and the one with the most
neighbours), and the overlap of each pair is counted on the whole multisets. The other
members of a bucket, where they are of more than one class yet, are dealt to blocks of
about BLOCK nodes or BLOCK_BYTES of text, and each two blocks are held against each other
exactly, by the product of their members' shingle tables. So every two nodes of a bucket
are in one class or were compared. Two blocks give a forest of links at most: copies are
never expanded into pairs, and no bucket is gathered.

Defined cases: null and empty texts have no shingle and are near copies of their equals
only (null is not equal to empty); texts of one to four words are one shingle; rows are
judged by their texts, so that unlike texts of one id are apart; a null id has the class
of its text, null if no row of the class has an id; other columns are ignored by
``classes`` and pass through ``deduplicated``, which keeps every row of a class without an
id. ``docs`` must be a stable scan (files or a table), as rows are known by their place in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, slices
from .components import components
from .words import U, Words, mix, windows, words

#: Words of a shingle, least similarity, registers, registers of a band, nodes and bytes of text in a block, and cells of a shingle table.
SHINGLE, SIMILAR, REGISTERS, BAND, BLOCK, BLOCK_BYTES, CELLS = 5, 0.8, 100, 5, 1024, 2 << 20, 1 << 21
BANDS = REGISTERS // BAND


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count), by row then hash."""
    sizes = np.diff(w.rows)
    long = windows(w.hashes, SHINGLE)
    count = np.maximum(sizes - SHINGLE + 1, 0)
    at = np.repeat(w.rows[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    row, h = np.repeat(np.arange(len(sizes)), count), long[at]
    for n in range(1, SHINGLE):
        of = np.flatnonzero(sizes == n)
        if len(of):
            row = np.concatenate([row, of])
            h = np.concatenate([h, mix(windows(w.hashes, n)[w.rows[of]] + U(n))])
    by = np.lexsort((h, row))
    row, h = row[by], h[by]
    cut = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
    return row[cut], h[cut], np.diff(np.append(cut, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    """A double in (0, 1) from 64 bits."""
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Earliest point's time in each register, n x REGISTERS; inf without shingles."""
    out = np.full(n * REGISTERS, np.inf)
    limit = np.full(n, np.inf)
    top = int(weight.max(initial=0))
    parts, k = [], 0
    while (low := 0 if k == 0 else 1 << (k - 1)) < top:
        of = np.flatnonzero(weight > low)
        width = max(low, 1)
        parts.append((row[of], mix(h[of] + U(k * 0xD1B54A32D192ED03 % 2**64)), np.full(len(of), width, np.float64), (weight[of] - low).astype(np.float64)))
        k += 1
    if not parts:
        return out.reshape(n, REGISTERS)
    r, key, rate, room = (np.concatenate(x) for x in zip(*parts, strict=True))
    t, turn = np.zeros(len(r)), 0
    while len(r):
        turn += 1
        x = mix(key + U(turn * 0x9E3779B97F4A7C15 % 2**64))
        t = t - np.log(_unit(x)) / rate
        y = mix(x ^ U(0xBF58476D1CE4E5B9))
        live = t < limit[r]
        if not live.all():
            r, key, rate, room, t, y = (a[live] for a in (r, key, rate, room, t, y))
        inside = _unit(mix(y)) * rate < np.ceil(room)  # the bits of the place are the left or right turns
        register = (y % U(REGISTERS)).astype(np.int64)
        np.minimum.at(out, (r * REGISTERS + register)[inside], t[inside])
        if turn < 6 or turn % 4 == 0:
            limit = out.reshape(n, REGISTERS).max(1)
    return out.reshape(n, REGISTERS)


def banded(sig: np.ndarray) -> np.ndarray:
    """Band keys, n x BANDS."""
    bits = sig.view(U)
    keys = np.empty((len(sig), BANDS), U)
    for b in range(BANDS):
        k = np.full(len(sig), U(b + 1))
        for c in range(b * BAND, (b + 1) * BAND):
            k = mix(k * U(0x9FB21C651E98DF25) + bits[:, c])
        keys[:, b] = k
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text) to (rid, bands); bands is null without shingles."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            row, h, count = shingles(words(part.column(1)))
            sig = signatures(row, h, count, part.num_rows)
            flat = pa.array(banded(sig).view(np.int64).ravel())
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), flat, mask=pa.array(~np.isfinite(sig[:, 0])))
            yield pa.RecordBatch.from_arrays([part.column(0), bands], ["rid", "bands"])


def _bag(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    _, h, count = shingles(words(pa.array([zstandard.decompress(packed)], pa.binary()).cast(pa.string())))
    return h, count


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    total = int(a[1].sum() + b[1].sum())
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return shared / (total - shared) if total else 1.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, za, zb) to the pairs that are similar enough."""
    held: dict[int, tuple] = {}
    for batch in batches:
        good = np.zeros(batch.num_rows, bool)
        a, b = (batch.column(k).to_pylist() for k in (0, 1))
        for i in range(batch.num_rows):
            if a[i] not in held:
                held = {} if len(held) > 64 else held
                held[a[i]] = _bag(batch.column(2)[i].as_py())
            good[i] = overlap(held[a[i]], _bag(batch.column(3)[i].as_py())) >= SIMILAR
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))


def shared(row: np.ndarray, h: np.ndarray, count: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shingles that each text of ``left`` has in common with each of ``right``, repeats counted."""
    turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    row, h = np.repeat(row, count), np.repeat(h, count)
    h = np.where(turn > 0, mix(h + turn.astype(U) * U(0x9E3779B97F4A7C15)), h)  # the second, third, ... of a shingle are keys of their own
    by = np.argsort(h, kind="stable")
    row, h = row[by], h[by]
    cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.append(cut, len(h)))
    row, size = row[np.repeat(size > 1, size)], size[size > 1]
    column = np.repeat(np.arange(len(size)), size)
    n, out = int(max(left.max(), right.max())) + 1, np.zeros((len(left), len(right)), np.float32)
    wide = max(1, CELLS // n)
    for at in range(0, len(size), wide):
        some = slice(*np.searchsorted(column, [at, at + wide]))
        table = np.zeros((n, min(wide, len(size) - at)), np.float32)
        table[row[some], column[some] - at] = 1
        out += table[left] @ table[right].T
    return out


def _blocks(group: pa.Table) -> pa.Table:
    """Two blocks of a bucket (i, j, k, id, c, z) to a forest of links between their classes."""
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    k, ids, c = (group.column(x).to_numpy() for x in ("k", "id", "c"))
    a, b = [], []
    left, right = np.flatnonzero(k == i), np.flatnonzero(k == j)
    if len(left) and len(right) and c.min() != c.max():
        row, h, count = shingles(words(pa.array([zstandard.decompress(z.as_py()) for z in group.column("z")], pa.binary()).cast(pa.string())))
        total = np.bincount(row, count, len(ids))
        both = shared(row, h, count, left, right)
        part = max(1, CELLS // len(right))
        root = {x: x for x in c.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for at in range(0, len(left), part):
            of, same = left[at : at + part], both[at : at + part].astype(np.float64)
            near = (same / np.maximum(total[of][:, None] + total[right] - same, 1) >= SIMILAR) & (c[of][:, None] != c[right])
            for x, y in zip(*np.nonzero(near), strict=True):
                x, y = of[x], right[y]
                cx, cy = find(int(c[x])), find(int(c[y]))
                if cx != cy:
                    root[cx] = cy
                    a.append(min(ids[x], ids[y]))
                    b.append(max(ids[x], ids[y]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack.compress(t.encode()) for t in batch.column(1).to_pylist()], pa.binary())], ["id", "z"])


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, class_id) of every row; class_id is the smallest id of its near copies, rid the row's number in the scan."""
    found, first = _components(docs, id_col, text_col)
    named = first.groupBy("comp").agg(F.min("id").alias("class_id"))
    return found.join(first.join(named, "comp").select("k1", "k2", "class_id"), ["k1", "k2"]).select("rid", "doc_id", "class_id")


def _components(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id, k1, k2) of every row; and (k1, k2, node, id, comp) of every distinct text: its first row, smallest id and component."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).withColumn("rid", F.monotonically_increasing_id())
    rows = rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(7), "text")})
    first = checkpoint(rows.groupBy("k1", "k2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("id"), F.max(F.octet_length("text")).alias("bytes")))
    one = rows.where("text is not null").select(F.col("rid").alias("node"), "text").join(first.select("node", "bytes"), "node")
    signed = rows.where("text is not null").select("rid", "text").mapInArrow(_sign, "rid long, bands array<long>").where("bands is not null")
    signed = checkpoint(signed.withColumnRenamed("rid", "node").join(first.select("node", "bytes"), "node"))
    band = signed.select("node", "bytes", F.explode("bands").alias("bucket"))
    size = band.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    # the degree of a node is the sum of its buckets' sizes: the text that others were copied from has the highest
    degree = band.select("node", "bucket").join(size, "bucket").groupBy("node").agg(F.sum("size").alias("degree"))
    placed = checkpoint(band.join(degree, "node").join(size.select("bucket"), "bucket").select("bucket", "node", "bytes", "degree"))
    hubs = placed.groupBy("bucket").agg(F.min("node").alias("h1"), F.min(F.struct((-F.col("degree")).alias("d"), "node")).alias("h2"))
    hubs = hubs.select("bucket", F.explode(F.array("h1", "h2.node")).alias("hub"))
    text = checkpoint(one.select("node", "text").join(placed.select("node").distinct(), "node").mapInArrow(_squeeze, "id long, z binary"))
    comp, found = components(_checked(_linked(placed, hubs), text))
    more = checkpoint(_rest(placed, hubs, comp, text))
    if not more.isEmpty():
        comp, found = components(found.unionByName(more))
    comp = comp.withColumnRenamed("id", "node")
    return rows.select("rid", "doc_id", "k1", "k2"), first.join(comp, "node", "left").select("k1", "k2", "node", "id", F.coalesce("comp", "node").alias("comp"))


def _checked(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs (a, b) that overlap enough; rows of one ``a`` come together."""
    a = text.select(F.col("id").alias("a"), F.col("z").alias("za"))
    b = text.select(F.col("id").alias("b"), F.col("z").alias("zb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "za", "zb").mapInArrow(_verify, "a long, b long").distinct()


def _linked(placed: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (a < b) of the buckets' members with the buckets' hubs."""
    pairs = placed.select("bucket", "node").join(hubs, "bucket").where("node <> hub")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _rest(placed: DataFrame, hubs: DataFrame, comp: DataFrame, text: DataFrame) -> DataFrame:
    """Links (a < b) between a bucket's members that are no hubs of it; a hub has met all."""
    label = comp.select(F.col("id").alias("m"), "comp")
    member = placed.select("bucket", F.col("node").alias("id"), "bytes").join(hubs.select("bucket", F.col("hub").alias("id")), ["bucket", "id"], "left_anti")
    member = checkpoint(member.join(label, F.col("id") == F.col("m"), "left").select("bucket", "id", "bytes", F.coalesce("comp", "id").alias("c")))
    many = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int")
    open_ = member.groupBy("bucket").agg(many.alias("many"), F.min("c").alias("least"), F.max("c").alias("most")).where("least < most")
    dealt = member.join(open_.select("bucket", "many"), "bucket").withColumn("k", F.pmod(F.xxhash64("id"), F.col("many")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    dealt = dealt.select("bucket", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"), "k", "id", "c").join(text, "id")
    return dealt.groupBy("bucket", "i", "j").applyInArrow(_blocks, "a long, b long").distinct()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the first of the smallest id."""
    found, first = _components(docs, id_col, text_col)
    known = found.where("doc_id is not null").join(first.select("k1", "k2", "comp"), ["k1", "k2"])
    best = known.groupBy("comp").agg(F.min(F.struct("doc_id", "rid")).alias("m"))
    bare = found.where("doc_id is null").join(first.select("k1", "k2", "comp"), ["k1", "k2"]).join(best.select("comp"), "comp", "left_anti")
    kept = best.select(F.col("m.rid").alias("__td_rid")).unionByName(bare.select(F.col("rid").alias("__td_rid")))
    return docs.withColumn("__td_rid", F.monotonically_increasing_id()).join(kept, "__td_rid", "left_semi").drop("__td_rid")
