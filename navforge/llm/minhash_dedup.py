"""Near-duplicate documents by MinHash banding (operator 8).

A document's set holds the distinct hashes of its k-word shingles (whole text,
A-Z lower-cased; with fewer words the whole sequence is one shingle).  Two
documents are linked when intersection / union >= threshold, confirmed on the
full sets; documents are grouped by the links' connected components.

1. Sketch: set size, a 128-bit digest of the set, HASHES minima of
   multiply-shift universal hashes, and one key per band of ROWS minima.
2. Documents with equal sets collapse to the one with the smallest id, so
   thousands of exact copies count once from here on.
3. Buckets of equal band keys are aggregated to (smallest member, count).  A member
   of a bucket with company meets the leaders of its buckets only, and is paired
   with the one it shares most bands with: at most one pair for each document.
   Signatures screen the pairs, full sets confirm them.
4. Components by large-star and small-star.  Sets of one id are linked as well.
5. A bucket whose members lie in several components can still hide a link.  Its
   signatures are compared across components, in pairs of bounded tiles, of which
   those of the bucket's largest component never meet each other; members of a pair that may reach the threshold, in the first band that it shares,
   meet again with their texts in the same tiles, where exact intersections come
   from products of 0/1 matrices.  A tile returns the edges of a spanning forest
   of its links, so a dense group of m documents that are nearly but not quite
   linked costs time, never m * m rows.  Then 4 again.

A pair at the threshold of 0.8 shares a band with probability 1 - 7e-6 and
passes the signature screen (five standard deviations below) with 1 - 3e-7.
A shingle is known by a 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, emit, longs, release_shuffles, text_slices
from navforge.llm.components import connected_components
from navforge.llm.words import Words, mix

HASHES = 150
ROWS = 5
#: Bounds of a tile, members and (on average) shingles of their sets; a group is a pair of tiles.
TILE = 1024
TILE_SHINGLES = 1 << 21
#: Most bits of the bitmap that drops rows before a shuffle (broadcast: an eighth in bytes).
FILTER_BITS = 1 << 27
#: Columns of a 0/1 matrix of sets that are multiplied at a time.
COLUMNS = 4096

_SKETCH = pa.schema([("row_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()),
                     ("s2", pa.int64()), ("sig", pa.binary()),
                     ("bands", pa.list_(pa.int64()))])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MEMBER = pa.schema([("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()),
                     ("node", pa.int64()), ("component", pa.int64())])


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = Words(texts, lower=True)
    if not len(w.start):
        return [np.empty(0, np.uint64)] * len(texts)
    pos = np.arange(len(w.start)) - w.first[:-1][w.doc]
    at = np.flatnonzero(pos + k <= w.count[w.doc])
    h = w.windows(at, k)
    bound = np.searchsorted(at, w.first)
    out = []
    for i in range(len(texts)):
        if 0 < w.count[i] < k:
            out.append(w.windows(w.first[i:i + 1], int(w.count[i])))
        else:
            out.append(np.unique(h[bound[i]:bound[i + 1]]))
    return out


def _universal(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(4242)
    a = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, hashes, dtype=np.uint64)[:, None]


def _sketch(k: int, hashes: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _universal(hashes)
        shift, bands = np.uint64(32), hashes // rows
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        weight = mix(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                sets = shingle_sets(texts, k)
                sig = np.full((len(sets), hashes), 0xFFFFFFFF, np.uint32)
                digest = np.zeros((len(sets), 2), np.int64)
                for i, s in enumerate(sets):
                    if not len(s):
                        continue
                    for j in range(0, len(s), 4096):
                        low = ((mul * s[None, j:j + 4096] + add) >> shift).min(axis=1)
                        np.minimum(sig[i], low.astype(np.uint32), out=sig[i])
                    digest[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16)
                                              .digest(), np.int64)
                key = (sig.reshape(len(sets), bands, rows).astype(np.uint64) * weight).sum(axis=2)
                key = mix(mix(key) ^ salt).view(np.int64)
                n = np.array([len(s) for s in sets], np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1) * bands, pa.int32()),
                    pa.array(key.ravel()))
                schema, h = _SKETCH, part.schema.get_field_index("h")
                if h >= 0:
                    schema = _SKETCH.append(pa.field("h", pa.int64()))
                yield from emit(schema, part.column(part.schema.get_field_index("row_id")), n,
                                digest[:, 0], digest[:, 1],
                                pa.array([r.tobytes() for r in sig], pa.binary()), lists,
                                *([part.column(h)] if h >= 0 else []))
    return run


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of equally long signatures as a matrix."""
    c = batch.column(batch.schema.get_field_index(column))
    data = b"".join(c.to_pylist())
    return np.frombuffer(data, np.uint32).reshape(len(c), -1)


def _alike(least: int):
    """Pairs whose signatures agree ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (_matrix(batch, "sig_a") == _matrix(batch, "sig_b")).sum(axis=1)
            at = np.flatnonzero(same >= least)
            if len(at):
                yield from emit(_PAIR, longs(batch, "a")[at], longs(batch, "b")[at])
    return run


def _confirm(k: int, per_cent: int):
    """Pairs whose full sets have 100 * intersection >= per_cent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                left, right = (
                    [b for _, texts in text_slices(part, c) for b in texts]
                    for c in ("text_a", "text_b"))
                one = {t: None for t in [*left, *right]}  # a leader's text recurs
                one = dict(zip(one, shingle_sets(list(one), k)))
                ok = np.zeros(part.num_rows, bool)
                for j, (x, y) in enumerate(zip(left, right)):
                    x, y = one[x], one[y]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - both
                    ok[j] = both > 0 and 100 * both >= per_cent * union
                at = np.flatnonzero(ok)
                if len(at):
                    yield from emit(_PAIR, longs(part, "a")[at], longs(part, "b")[at])
    return run


def of_ids(df: DataFrame, ids: DataFrame, column: str = "node") -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``ids`` (distinct longs), few others being
    shuffled: a bitmap of the hashed ids, of at most FILTER_BITS bits, drops most rows
    where they are read.  Where ids outnumber its bits it drops little; the join that
    follows is exact either way."""
    bits = min(max(16 * ids.count(), 1 << 15), FILTER_BITS)
    bits = 1 << (bits - 1).bit_length()

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits)) + 1

    bitmap = ids.select(place(column).alias("p")).groupBy(
        F.bitmap_bucket_number("p").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    at = F.bitmap_bit_position(place(column))
    hit = F.expr("shiftright(cast(conv(hex(substring(__bits, cast(__at div 8 as int) + 1, 1)), "
                 "16, 10) as int), cast(__at % 8 as int)) & 1")
    marked = df.withColumn("__bucket", F.bitmap_bucket_number(place(column))).withColumn("__at", at)
    near = marked.join(F.broadcast(bitmap), "__bucket").filter(hit == 1)
    return near.select(df.columns).join(ids, column, "left_semi")


def sorted_pieces(batches: Iterator[pa.RecordBatch], keys: list[str]
                  ) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """(whether a run of equal keys begins, a piece of the run) of a partition sorted by
    them; a piece lies within one batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [longs(batch, k) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        edges = [0, *np.flatnonzero(new), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            yield bool(a) or first != last, batch.slice(a, b - a)
        last = tuple(c[-1] for c in cols)


def _whole(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of all rows.  Bytes get 64-bit offsets: with 32 bits a column of over
    2 GiB comes back as several batches."""
    if len(pieces) == 1:
        return pieces[0]
    large = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
    table = pa.Table.from_batches(pieces)
    table = table.cast(pa.schema([f.with_type(large.get(f.type, f.type)) for f in table.schema]))
    [batch] = table.combine_chunks().to_batches()
    return batch


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The runs of equal keys of a partition sorted by them, one record batch each."""
    held: list[pa.RecordBatch] = []
    for new, piece in sorted_pieces(batches, keys):
        if new and held:
            yield _whole(held)
            held = []
        held.append(piece)
    if held:
        yield _whole(held)


def _screen(least: int, rows: int):
    """Members of each pair of tiles with a pair of different components that may reach
    the threshold and shares no earlier band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "i", "j"]):
            comp, tile = longs(g, "component"), longs(g, "tile")
            if len(comp) < 2 or (comp == comp[0]).all():
                continue
            i, j, band = longs(g, "i")[0], longs(g, "j")[0], int(longs(g, "band")[0])
            sig = _matrix(g, "sig")
            x, y = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
            used = np.zeros(len(comp), bool)
            for r in range(0, len(x), 32):
                xs = x[r:r + 32]
                same = sig[xs, None, :] == sig[None, y, :]
                ok = (same.sum(axis=2) >= least) & (comp[xs, None] != comp[None, y])
                if band and ok.any():
                    shared = same[:, :, :band * rows].reshape(len(xs), len(y), band, rows)
                    ok &= ~shared.all(axis=3).any(axis=2)
                a, b = np.nonzero(ok)
                used[xs[a]] = used[y[b]] = True
            at = np.flatnonzero(used)
            if len(at):
                yield from emit(_MEMBER, *(longs(g, c)[at] for c in _MEMBER.names))
    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of 0/1 matrices."""
    n = len(sets)
    if n <= 4:
        return np.array([[len(np.intersect1d(s, t, assume_unique=True)) for t in sets]
                         for s in sets], np.float32).reshape(n, n)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # elements of one set alone meet nothing
    owner, column = owner[count[column] > 1], number[column[count[column] > 1]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [c, c + COLUMNS])
        m = np.zeros((n, COLUMNS), np.float32)
        m[owner[lo:hi], column[lo:hi] - c] = 1
        out += m @ m.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def forest(link: np.ndarray) -> np.ndarray:
    """For each row the first row of its component in a symmetric link matrix."""
    x, y = np.nonzero(link)
    label = np.arange(len(link))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _exact(k: int, per_cent: int):
    """Edges of a spanning forest of the links within each pair of tiles.  Texts become
    sets as they arrive; a tile holds no texts."""
    def edges(nodes: list[np.ndarray], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(sets) < 2:
            return
        size = np.array([len(s) for s in sets], np.float32)
        both = intersections(sets)
        union = size[:, None] + size[None, :] - both
        link = (both > 0) & (100 * both.astype(np.float64) >= per_cent * union)
        label, node = forest(link), np.concatenate(nodes)
        at = np.flatnonzero(node != node[label])
        if len(at):
            yield from emit(_PAIR, node[at], node[label[at]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sets = [], []
        for new, piece in sorted_pieces(batches, ["key", "i", "j"]):
            if new:
                yield from edges(nodes, sets)
                nodes, sets = [], []
            nodes.append(longs(piece, "node"))
            for _, texts in text_slices(piece, "text"):
                sets += shingle_sets(texts, k)
        yield from edges(nodes, sets)
    return run


def near_duplicates(docs: DataFrame, *, words: int = 5, per_cent: int = 80, hashes: int = HASHES,
                    rows: int = ROWS, text_hash: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null or wordless texts have an empty set and stand alone.  Rows that share a
    ``doc_id`` count as one node (linked when any of their texts is).  Rows with
    a null ``doc_id`` are linked with nothing and get a null component and kept.
    ``text_hash`` adds a column of that name, xxhash64 of the text, which tells
    rows of one ``doc_id`` apart.
    """
    if hashes % rows:
        raise ValueError("rows must divide hashes")
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash-dedup")
    # Five standard deviations of the estimate below the threshold.
    p = per_cent / 100
    least = max(rows, int(hashes * (p - 5 * (p * (1 - p) / hashes) ** 0.5)))
    base = docs.select(F.col("doc_id").cast("long").alias("row_id"),
                       F.col("text").cast("binary").alias("text"))
    hashed = base.withColumn("h", F.xxhash64("text")) if text_hash else base
    sketch = scratch.write(
        hashed.mapInArrow(_sketch(words, hashes, rows), "row_id long, n long, s1 long, s2 long, "
                          "sig binary, bands array<long>" + ", h long" * text_hash), "sketch")
    sets = scratch.write(sketch.filter("n > 0 and row_id is not null").groupBy("s1", "s2", "n")
                         .agg(F.min("row_id").alias("node")), "sets")
    nodes = sketch.join(sets.withColumnRenamed("node", "row_id"), ["s1", "s2", "n", "row_id"],
                        "left_semi").withColumnRenamed("row_id", "node")
    nodes = scratch.write(nodes.select("node", "n", "sig", "bands"), "nodes")
    banded = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    buckets = scratch.write(banded.groupBy("key").agg(F.min("node").alias("leader"),
                                                      F.max("node").alias("top"))
                            .filter("leader < top").drop("top"), "buckets")
    members = scratch.write(banded.join(buckets, "key"), "members")
    # A node's best leader is the one it shares most bands with.
    best = scratch.write(
        members.filter("node <> leader").groupBy("leader", "node").count().groupBy("node").agg(
            F.max_by("leader", F.struct("count", -F.col("leader"))).alias("leader")), "best")
    wanted = scratch.write(best.select("node").union(buckets.select("leader")).distinct(), "wanted")
    sigs = scratch.write(of_ids(nodes.select("node", "sig"), wanted), "sigs")

    def texts(ids: DataFrame, name: str) -> DataFrame:
        ids = scratch.write(ids.distinct(), f"{name}-ids")
        return scratch.write(of_ids(base.withColumnRenamed("row_id", "node"), ids), name)

    def pairs(of: DataFrame, by: DataFrame, column: str) -> DataFrame:
        def side(end: str) -> DataFrame:
            return by.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}"))

        return of.join(side("b"), "b").join(side("a"), "a").select(
            "a", "b", f"{column}_a", f"{column}_b")

    led = best.select(F.col("leader").alias("a"), F.col("node").alias("b"))
    alike = scratch.write(pairs(led, sigs, "sig").mapInArrow(_alike(least), "a long, b long"),
                          "alike")
    ends = texts(alike.select(F.col("a").alias("node")).union(alike.select("b")), "ends")
    links = scratch.write(pairs(alike, ends, "text").mapInArrow(
        _confirm(words, per_cent), "a long, b long"), "links")
    scratch.drop("ends")
    release_shuffles(spark)
    # The sets of one id are linked by the id, which is no smaller than their nodes.
    filled = sketch.filter("n > 0 and row_id is not null").select("row_id", "s1", "s2", "n")
    one = F.struct("s1", "s2", "n")
    several = scratch.write(filled.groupBy("row_id").agg(F.min(one).alias("x"),
                                                         F.max(one).alias("y"))
                            .filter("x <> y").select("row_id"), "several")
    if not several.isEmpty():
        same = (filled.join(several, "row_id").join(sets, ["s1", "s2", "n"])
                .filter("node <> row_id").select(F.col("row_id").alias("a"),
                                                 F.col("node").alias("b")))
        links = scratch.write(links.unionByName(same.distinct()), "linked")
    labels = connected_components(links, scratch, "cc")

    here = scratch.write(members.join(labels, "node", "left").select(
        "key", "band", "node", "n", F.coalesce("component", "node").alias("component")), "here")
    # Of a bucket in several components: the largest one, and the tiles of the others
    # (numbered first) and of its own.
    by_component = here.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))

    def tiles(members: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(members / TILE, shingles / TILE_SHINGLES)).cast("long")

    split = scratch.write(
        by_component.groupBy("key").agg(
            F.max(F.struct("members", "shingles", "component")).alias("main"),
            F.sum("members").alias("members"), F.sum("shingles").alias("shingles"))
        .filter(F.col("members") > F.col("main.members"))
        .select("key", F.col("main.component").alias("main"),
                tiles(F.col("members") - F.col("main.members"),
                      F.col("shingles") - F.col("main.shingles")).alias("others"),
                tiles(F.col("main.members"), F.col("main.shingles")).alias("own")), "split")
    hashed_node, is_main = F.xxhash64("node"), F.col("component") == F.col("main")
    number = F.when(is_main, F.col("others") + F.pmod(hashed_node, F.col("own"))).otherwise(
        F.pmod(hashed_node, F.col("others")))
    meets = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("own"))
    tiled = (here.join(split, "key").join(sigs, "node").withColumn("tile", number)
             .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)))
             .select("key", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"),
                     "tile", F.col("band").cast("long").alias("band"), "node", "component", "sig"))
    tile = ["key", "i", "j"]
    screened = scratch.write(
        tiled.repartition(*tile).sortWithinPartitions(*tile)
        .mapInArrow(_screen(least, rows), "key long, i long, j long, node long, component long"),
        "screened")
    release_shuffles(spark)
    found = scratch.write(
        screened.join(texts(screened.select("node"), "tiled-texts"), "node")
        .select(*tile, "node", "text")
        .repartition(*tile).sortWithinPartitions(*tile)
        .mapInArrow(_exact(words, per_cent), "a long, b long"), "found")
    if not found.isEmpty():
        labels = connected_components(links.unionByName(found), scratch, "cc2")
    classes = scratch.write(sets.join(labels, "node", "left").select(
        "s1", "s2", "n", F.coalesce("component", "node").alias("component_id")), "classes")
    scratch.drop("sets", "nodes", "buckets", "members", "best", "wanted", "sigs", "alike", "links",
                 "linked", "several", "here", "split", "screened", "tiled-texts", "found",
                 "cc-labels", "cc2-labels")
    out = sketch.drop("sig", "bands").join(classes, ["s1", "s2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("row_id"))
    component = F.when(F.col("row_id").isNotNull(), component)
    return out.select(F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      (F.col("row_id") == component).alias("kept"),
                      *([F.col("h").alias("text_hash")] if text_hash else []))
