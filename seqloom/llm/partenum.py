"""Exact n-gram Jaccard join by PartEnum signatures.

Two sets of sizes a <= b with Jaccard similarity of at least 3/4 differ in at most (a + b) / 7 features, that is a / 3 at most. Sizes fall
into bands (powers of two); a set that may have partners in the next band signs there too. In a band the feature domain (64-bit
shingle hashes) is cut into first-level parts by hash, each of which has SECOND second-level parts. A set signs, for each first-level part
and each subset of SECOND - 1 of its second-level parts, what it holds in that subset, unless that is nothing.

Of a pair that differs in k features at most k second-level parts differ. A first-level part with at most one differing part and an equal one that isn't empty
gives the pair a common signature: the subset without the differing part. Only first-level parts with two or more differing parts fail, k / 2 at most, and each
hides one equal part at most. So if either set occupies more than k + k // 2 second-level parts, the pair shares a signature; and signing the leading
first-level parts up to that number is enough.

Very frequent shingles (in at least ``hot_share`` of the texts) are left out of the signed domain, which
never increases the number of differing features. Sets that then occupy too few parts sign single
features of the full domain besides, k + 1 of them in order; two such sets always meet there. The frequent list is an
efficiency measure alone: whatever it holds, the result is the same. It has at most
mean set size / ``hot_share`` entries, which bounds its broadcast.

Texts that share a signature form a group. No group is expanded into pairs: the smallest id of a group
is compared with its other members exactly, connected components follow, and only members of a group
that still lie in different components are compared further. Texts with equal sets are one class before anything is
signed, and only its smallest id signs. Of a large open group, the members outside its largest component meet each
other and that component in blocks of about ``BLOCK`` rows a side; the largest component doesn't meet itself.

Before texts are compared, a lossless bound sorts out most candidates: a set's parity sketch has one bit
for each residue of its features' hashes, the parity of their number. Every differing feature flips one
bit, so two sketches differ in at most as many bits as the sets differ in features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import components, free_name, mix64, stage, text_slices
from seqloom.llm.shingles import shingle_sets

SIMILAR = 75
HOT_SHARE = 0.001
RUN_SHINGLES = 1_400_000
FIRST_GROUPS = 16
SMALL_GROUP, BLOCK = 64, 1024
KEPT = 5  # bytes of a signature that are sent besides its part; what falls together by chance is verified away
_FULL = 100  # namespace of the full domain's signatures
_EDGE, _GROUP = 1, 2


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that at least three texts of a run of some 2,500 hold, with that number."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.sort(np.concatenate(held))
        at = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])[: len(flat)])
        n = np.diff(np.append(at, len(flat)))
        return pa.RecordBatch.from_arrays([pa.array(flat[at][n >= 3].view(np.int64)), pa.array(n[n >= 3])], ["h", "n"])

    held: list[np.ndarray] = []
    for batch in batches:
        for _, _, data, offsets in text_slices(batch, "text"):
            held.append(shingle_sets(data, offsets)[0])
            if sum(map(len, held)) >= RUN_SHINGLES:
                yield counted(held)
                held = []
    if held:
        yield counted(held)


def frequent_shingles(docs: DataFrame, share: float) -> np.ndarray:
    """Sorted hashes of shingles in at least ``share`` of all texts (short slices may miss borderline ones)."""
    total = docs.count()
    rows = docs.select("text").mapInArrow(_frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= max(64, share * total)).select("h").toPandas()
    return np.sort(rows["h"].to_numpy(np.int64).view(np.uint64))


SECOND = 3
SPREAD = 1  # second-level parts a band has for each feature of its smallest sets; fewer make larger signatures, and too few occupied parts


def sign(flat: np.ndarray, at: np.ndarray, hot: np.ndarray, fallback: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) for sorted sets ``flat[at[i]:at[i + 1]]``."""
    size = np.diff(at)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    rare = np.ones(len(flat), bool)
    if len(hot):
        rare = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] != flat
    band = np.where(size > 0, np.floor(np.log2(np.maximum(size, 1))).astype(np.int64), 0)
    above = 4 * size >= 3 * (np.int64(2) << band)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    short = np.zeros(len(size), bool)
    one_way = mix64(flat)
    for step, who in ((0, size > 0), (1, above & (size > 0))):
        idx = np.flatnonzero(rare & who[owner])
        own = owner[idx]
        space = band[own] + step
        # the features' order is that of their parts: leading bits times the number of parts
        parts = ((SPREAD << space) // SECOND + 1) * SECOND
        part = ((flat[idx] >> np.uint64(32)) * parts.astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(idx), bool)
        new[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        own, part, space = own[first], part[first].astype(np.int64), space[first]
        value = np.add.reduceat(one_way[idx], first) if len(first) else np.zeros(0, np.uint64)
        most = np.minimum(size // 3, (size + (np.int64(2) << (band + step)) - 1) // 7)
        need = most + most // 2 + 1
        short |= who & (np.bincount(own, minlength=len(size)) < need)
        run = np.arange(len(own)) - np.searchsorted(own, own)
        lead, second = part // SECOND, part % SECOND
        group = np.ones(len(own), bool)
        group[1:] = (own[1:] != own[:-1]) | (lead[1:] != lead[:-1])
        heads = np.flatnonzero(group)
        table = np.zeros((len(heads), SECOND), np.uint64)
        table[np.cumsum(group) - 1, second] = value
        heads_own, signed = own[heads], run[heads] < need[own[heads]]
        for without in range(SECOND):
            keep = table.copy()
            keep[:, without] = 0
            full = signed & keep.any(1)
            sig = mix64(lead[heads].astype(np.uint64) * np.uint64(SECOND) + np.uint64(without) + (space[heads].astype(np.uint64) << np.uint64(56)))
            for k in range(SECOND):
                sig = mix64(sig ^ keep[:, k]) + np.uint64(k)
            found.append((sig[full], heads_own[full]))
    if fallback and short.any():
        idx = np.flatnonzero(short[owner])
        own = owner[idx]
        keep = np.arange(len(idx)) - np.searchsorted(own, own) <= size[own] // 3
        found.append((mix64(one_way[idx][keep] ^ np.uint64(_FULL << 56)), own[keep]))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tag, set size, 128-bit digest of the set)."""
    for batch in batches:
        ids, tags = batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("tag"))
        for i, j, data, offsets in text_slices(batch, "text"):
            flat, at = shingle_sets(data, offsets)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(flat ^ np.uint64(seed)))]) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            cols = [np.diff(at).astype(np.int32), *[(x[at[1:]] - x[at[:-1]]).view(np.int64) for x in sums]]
            yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), tags.slice(i, j - i), *[pa.array(c) for c in cols]], ["doc_id", "tag", "n", "d1", "d2"])


SENT = "p int, sigs binary, node array<long>, n array<int>, times array<int>"


def _signer(hot_ref, parts: int):
    """A row for each of ``parts`` of a slice: KEPT bytes of each signature, and for each set its size and how many are its own."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_ref.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("node")).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, data, offsets in text_slices(batch, "text"):
                flat, at = shingle_sets(data, offsets)
                sig, own = sign(flat, at, hot)
                if not len(sig):
                    continue
                part = ((sig >> np.uint64(8 * KEPT)) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((own, part))
                sig, own, part = sig[order], own[order], part[order]
                new = np.ones(len(sig), bool)
                new[1:] = (part[1:] != part[:-1]) | (own[1:] != own[:-1])
                runs = np.flatnonzero(new)
                heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                packed = np.ascontiguousarray(sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT]).ravel()
                cuts = (np.append(heads, len(sig)) * KEPT).astype(np.int32)
                lists = np.append(np.searchsorted(runs, heads), len(runs)).astype(np.int32)
                listed = lambda x: pa.ListArray.from_arrays(pa.array(lists), pa.array(x))  # noqa: B023, E731
                columns = [
                    pa.array(part[heads].astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(cuts), pa.py_buffer(packed)]),
                    listed(ids[i:j][own[runs]]), listed(np.diff(at)[own[runs]].astype(np.int32)), listed(np.diff(np.append(runs, len(sig))).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["p", "sigs", "node", "n", "times"])

    return signed


def _sent(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node, set size) of all entries of a batch of ``SENT`` rows."""
    p, sigs, node, n, times = (batch.column(batch.schema.get_field_index(c)) for c in ("p", "sigs", "node", "n", "times"))
    at = np.frombuffer(sigs.buffers()[1], np.int32)[sigs.offset : sigs.offset + len(sigs) + 1]
    raw = np.frombuffer(sigs.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(-1, KEPT)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :KEPT] = raw
    sig = wide.view("<u8").ravel() | (np.repeat(p.to_numpy().astype(np.uint64), np.diff(at) // KEPT) << np.uint64(8 * KEPT))
    many = times.flatten().to_numpy()
    return sig, np.repeat(node.flatten().to_numpy(), many), np.repeat(n.flatten().to_numpy(), many)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group one shuffle partition by signature: edges to the least member, groups of three or more."""

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b.astype(np.int64))], ["kind", "a", "b"])

    held = [_sent(batch) for batch in batches if batch.num_rows]
    if not held:
        return
    sig, doc, n = (np.concatenate(c) for c in zip(*held, strict=True))
    del held
    order = np.argsort(sig, kind="stable")
    sig = sig[order]
    same = np.zeros(len(sig) + 1, bool)
    same[1:-1] = sig[1:] == sig[:-1]
    shared = same[:-1] | same[1:]
    order = order[shared]
    sig, doc, n = sig[shared], doc[order], n[order]
    if not len(sig):
        return
    order = np.lexsort((doc, sig))
    doc, n = doc[order], n[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    length = np.diff(np.append(first, len(sig)))
    head, head_n = np.repeat(doc[first], length), np.repeat(n[first], length)
    fits = (100 * np.minimum(n, head_n) >= SIMILAR * np.maximum(n, head_n)) & (doc != head)
    pair = np.unique(np.stack([head[fits], doc[fits]], 1), axis=0) if fits.any() else np.zeros((0, 2), np.int64)
    yield rows(_EDGE, pair[:, 0], pair[:, 1])
    lists = mix64(np.add.reduceat(mix64(doc.view(np.uint64)), first) + length.astype(np.uint64))
    _, once = np.unique(lists, return_index=True)
    pick = np.zeros(len(first), bool)
    pick[once] = True
    pick &= length >= 3
    member = np.repeat(pick, length)
    yield rows(_GROUP, np.repeat(lists, length)[member].view(np.int64), doc[member])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs that link: exact sizes of intersection and union of their shingle sets."""
    for batch in batches:
        left = {c: batch.column(batch.schema.get_field_index(c)) for c in ("a", "b")}
        good = []
        sides = [pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c))], ["text"]) for c in ("text_a", "text_b")]
        half = 1 << 21
        for (i, j, da, oa) in text_slices(sides[0], "text", half):
            fa, ata = shingle_sets(da, oa)
            for (p, q, db, ob) in text_slices(sides[1].slice(i, j - i), "text", half):
                fb, atb = shingle_sets(db, ob)
                for r in range(p, q):
                    x, y = fa[ata[r] : ata[r + 1]], fb[atb[r - p] : atb[r - p + 1]]
                    if not len(x) or not len(y):
                        continue
                    both = int(np.isin(x, y, assume_unique=True).sum())
                    if 100 * both >= SIMILAR * (len(x) + len(y) - both):
                        good.append(i + r)
        take = pa.array(np.array(good, np.int64))
        yield pa.RecordBatch.from_arrays([left["a"].take(take), left["b"].take(take)], ["a", "b"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, set size, parity sketch of 2 ** (band + 1) bits)."""
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("node")).to_numpy(zero_copy_only=False)
        for i, j, data, offsets in text_slices(batch, "text"):
            flat, at = shingle_sets(data, offsets)
            out = []
            for r in range(j - i):
                own = flat[at[r] : at[r + 1]]
                m = 8 << max(0, int(len(own)).bit_length() - 3)
                bits = np.bincount((own & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
                out.append(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids[i:j].astype(np.int64)), pa.array(np.diff(at).astype(np.int32)), pa.array(out, pa.binary())], ["doc", "n", "sketch"])


def _bits_apart(x: int, mx: int, y: int, my: int) -> int:
    """Differing bits of two parity sketches; the longer one is folded to the shorter one's length."""
    if mx < my:
        x, mx, y, my = y, my, x, mx
    while mx > my:
        mx //= 2
        x = (x >> mx) ^ (x & ((1 << mx) - 1))
    return (x ^ y).bit_count()


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs that the sizes and sketches allow to link."""
    for batch in batches:
        a, b, na, nb, xa, xb = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"))
        keep = [
            100 * min(n, m) >= SIMILAR * max(n, m) and 7 * _bits_apart(int.from_bytes(x, "little"), 8 * len(x), int.from_bytes(y, "little"), 8 * len(y)) <= n + m
            for n, m, x, y in zip(na, nb, xa, xb, strict=True)
        ]
        keep = np.array(keep, bool)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)[keep]), pa.array(np.array(b, np.int64)[keep])], ["a", "b"])


def _opens(x: frozenset, y: frozenset, g: int) -> bool:
    """Whether no group before ``g`` is known to hold both texts."""
    return all(k >= g for k in x & y)


def _large_group(c: np.ndarray, n: np.ndarray, sketch: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of allowed pairs between two blocks (or inside one) by bit matrices, one sketch length and the next longer one at a time."""
    size = np.array([8 * len(x) for x in sketch])
    same = np.array_equal(left, right)
    rows = [np.zeros((0, 2), np.int64)]

    def bits(places: np.ndarray, m: int) -> np.ndarray:
        out = np.zeros((len(places), m), np.float32)
        for r, i in enumerate(places):
            own = np.unpackbits(np.frombuffer(sketch[i], np.uint8), bitorder="little")
            out[r] = own if len(own) == m else own[:m] ^ own[m:]
        return out

    for x, y, lengths in ((left, right, (1, 2)), *(() if same else ((right, left, (2,)),))):
        for m in np.unique(size[x]).tolist():
            small, large = x[size[x] == m], y[np.isin(size[y], [k * m for k in lengths])]
            if not len(large):
                continue
            p, q = bits(small, m), bits(large, m)
            apart = p.sum(1)[:, None] + q.sum(1)[None, :] - 2 * (p @ q.T)
            a, b = n[small][:, None], n[large][None, :]
            ok = (7 * apart <= a + b) & (100 * np.minimum(a, b) >= SIMILAR * np.maximum(a, b)) & (c[small][:, None] != c[large][None, :])
            i, j = np.nonzero(ok)
            pair = np.stack([small[i], large[j]], 1)
            rows.append(pair[(size[pair[:, 0]] != size[pair[:, 1]]) | (pair[:, 0] < pair[:, 1])] if same else pair)
    return np.concatenate(rows)


def _across(key, table):
    """As ``_inside`` for two blocks of a large group, or one with itself."""
    g, bi, bj = (k.as_py() for k in key)
    node, c, n, block = (table.column(k).to_numpy().astype(np.int64) for k in ("node", "c", "n", "block"))
    low = [frozenset(x) for x in table.column("low").to_pylist()]
    at = _large_group(c, n, table.column("sketch").to_pylist(), np.flatnonzero(block == bi), np.flatnonzero(block == bj))
    at = at[np.array([_opens(low[i], low[j], g) for i, j in at.tolist()], bool)]
    pairs = np.unique(np.sort(node[at], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of small open groups that lie in different components and that sizes and sketches allow to link.

    A partition's groups are taken together and a pair that many of them share is looked at once. A pair is
    given only in the first of its groups, as far as the ``low`` lists (a text's first groups) tell.
    """
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    g, node, c, n = (table.column(k).to_numpy().astype(np.int64) for k in ("g", "node", "c", "n"))
    order = np.lexsort((node, g))
    g, node, c, n = g[order], node[order], c[order], n[order]
    sketch = table.column("sketch").take(pa.array(order))
    low = [frozenset(x) for x in table.column("low").take(pa.array(order)).to_pylist()]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    length = np.diff(np.append(first, len(g)))
    found = [np.zeros((0, 2), np.int64)]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in np.unique(length):
        i, j = np.triu_indices(m, 1)
        f = first[length == m][:, None]
        left.append((f + i).ravel())
        right.append((f + j).ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    ok = (c[left] != c[right]) & (100 * np.minimum(n[left], n[right]) >= SIMILAR * np.maximum(n[left], n[right]))
    left, right = left[ok], right[ok]
    by_group = np.argsort(left, kind="stable")  # so that a pair's first group is the one kept
    left, right = left[by_group], right[by_group]
    pair = np.stack([node[left], node[right]], 1)
    _, once = np.unique(pair, axis=0, return_index=True)
    left, right = left[once], right[once]
    used = np.unique(np.concatenate([left, right]))
    raw = dict(zip(used.tolist(), sketch.take(pa.array(used)).to_pylist(), strict=True))
    bits = {i: int.from_bytes(x, "little") for i, x in raw.items()}
    near = [7 * _bits_apart(bits[i], 8 * len(raw[i]), bits[j], 8 * len(raw[j])) <= s for i, j, s in zip(left.tolist(), right.tolist(), (n[left] + n[right]).tolist(), strict=True)]
    at = np.stack([left, right], 1)[np.array(near, bool)]
    found.append(node[at[[_opens(low[i], low[j], int(g[i])) for i, j in at.tolist()]]])
    pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _allowed(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    side = lambda c: sketches.select(F.col("doc").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_possible, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_check, "a long, b long")


def jaccard_components(docs: DataFrame, hot_share: float = HOT_SHARE, tagged: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs(doc_id, text)``.

    Null and wordless texts have an empty set and are their own component. Every row is a document: rows that share an id, with equal texts or not, each have their own
    text's set and component; rows without an id take part too, but their component's smallest id is that of the others, null if there is none.
    Other columns are ignored. Empty input gives an empty result. ``tagged`` adds the text's hash as ``tag``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    sets = docs.mapInArrow(_digests, "doc_id long, tag long, n int, d1 long, d2 long").groupBy("doc_id", "tag", "n", "d1", "d2").agg(F.count("*").alias("rows"))
    # a node is the id itself, or a hash for further texts of an id and for texts without one
    same_id = W.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("tag"))).orderBy("tag", "n", "d1", "d2")
    node = F.when((F.row_number().over(same_id) == 1) & F.col("doc_id").isNotNull(), F.col("doc_id")).otherwise(F.xxhash64(F.lit(3), "doc_id", "tag"))
    sets = stage(sets.withColumn("node", node), "partenum-sets")
    classes = sets.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(F.struct("node", "doc_id", "tag")).alias("r"))
    reps = classes.select("n", "d1", "d2", F.col("r.node").alias("rep"), F.col("r.doc_id").alias("_id"), F.col("r.tag").alias("_tag"))
    reps = stage(reps, "partenum-classes")
    of_row = sets.join(reps.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "left").select("doc_id", "tag", "rows", F.col("n").cast("long").alias("n_shingles"), F.coalesce("rep", "node").alias("rep"))
    chosen = reps.select(F.col("rep").alias("node"), "_id", "_tag").hint("shuffle_hash")
    docs = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["tag"] == F.col("_tag"))).select("node", "text")
    docs = stage(docs, "partenum-once")
    hot = spark.sparkContext.broadcast(frequent_shingles(docs, hot_share))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInArrow(_signer(hot, parts), SENT).repartitionById(parts, F.col("p")).mapInArrow(_gather, "kind byte, a long, b long")
    rows = stage(rows, "partenum")
    pairs = stage(rows.where(F.col("kind") == _EDGE).select("a", "b").distinct(), "partenum-pairs")
    groups = rows.where(F.col("kind") == _GROUP).select(F.col("a").alias("g"), F.col("b").alias("node"))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(groups.select("node")).distinct()
    texts = stage(docs.join(wanted.hint("shuffle_hash"), "node", "left_semi"), "partenum-texts")
    sketches = stage(texts.mapInArrow(_sketches, "doc long, n int, sketch binary"), "partenum-sketches")
    links = stage(_verified(stage(_allowed(pairs, sketches), "partenum-allowed"), texts), "partenum-links")
    found = components(links)
    inside = groups.join(found, "node", "left").select("g", "node", F.coalesce("component_id", "node").alias("c"))
    inside = stage(inside.distinct(), "partenum-inside")
    share = inside.groupBy("g", "c").agg(F.count("*").alias("m")).groupBy("g").agg(F.max(F.struct("m", "c")).alias("most"), F.sum("m").alias("t"))
    open_groups = stage(share.where(F.col("most.m") < F.col("t")), "partenum-share")  # a table of its own, so that Spark may split a large group in the join
    rest = stage(inside.join(open_groups, "g"), "partenum-open")
    known = rest.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("g")), 1, FIRST_GROUPS).alias("low"))
    ready = rest.join(known.join(sketches.withColumnRenamed("doc", "node").dropDuplicates(["node", "sketch"]), "node"), "node")
    more = ready.where(F.col("t") <= SMALL_GROUP).select("g", "node", "c", "n", "sketch", "low").repartition("g").mapInArrow(_inside, "a long, b long")
    own, deal = F.col("c") == F.col("most.c"), F.xxhash64(F.lit(7), "node")
    large = ready.where(F.col("t") > SMALL_GROUP).withColumns({"main": F.ceil(F.col("most.m") / BLOCK).cast("int"), "side": F.ceil((F.col("t") - F.col("most.m")) / BLOCK).cast("int")})
    large = large.withColumn("block", F.when(own, F.pmod(deal, F.col("main"))).otherwise(F.col("main") + F.pmod(deal, F.col("side"))).cast("int"))
    others = F.sequence(F.when(own, F.col("main")).otherwise(F.lit(0)), F.col("main") + F.col("side") - 1)
    meet = F.transform(others, lambda j: F.struct(F.least("block", j).alias("bi"), F.greatest("block", j).alias("bj")))
    large = large.select("g", "node", "c", "n", "sketch", "low", "block", F.inline(meet)).groupBy("g", "bi", "bj").applyInArrow(_across, "a long, b long")
    more = more.union(large).distinct().join(pairs, ["a", "b"], "left_anti")
    extra = stage(_verified(stage(more, "partenum-allowed"), texts), "partenum-links")
    if not extra.isEmpty():
        root = found.select(F.col("node").alias("_n"), F.col("component_id").alias("_c"))
        lifted = extra.join(root, F.col("a") == F.col("_n"), "left").select(F.coalesce("_c", "a").alias("a"), "b")
        lifted = lifted.join(root, F.col("b") == F.col("_n"), "left").select("a", F.coalesce("_c", "b").alias("b"))
        lift = components(lifted).select(F.col("node").alias("_n"), F.col("component_id").alias("_c"))
        every = found.union(extra.select("a", "a").union(extra.select("b", "b"))).groupBy("node").agg(F.min("component_id").alias("component_id"))
        found = every.join(lift, F.col("component_id") == F.col("_n"), "left").select("node", F.coalesce("_c", "component_id").alias("component_id"))
    parts = stage(of_row.join(found, of_row["rep"] == found["node"], "left").select("doc_id", "tag", "rows", "n_shingles", F.coalesce("component_id", "rep").alias("part")), "partenum-parts")
    least = parts.groupBy(F.col("part").alias("_part")).agg(F.min("doc_id").alias("component_id"))
    out = parts.join(least, parts["part"] == F.col("_part")).select("doc_id", "tag", "n_shingles", "component_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return out.select("doc_id", "n_shingles", "component_id", *(["tag"] if tagged else []))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their text's component.

    Rows without an id stay, since nothing names them; rows that repeat the smallest id with a text of the same component all stay. Other columns
    may have any name; an empty table gives an empty result.
    """
    key, tag = free_name(docs, "_id"), free_name(docs, "_tag")
    found = jaccard_components(docs.select("doc_id", "text"), tagged=True)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key), F.col("tag").alias(tag)).distinct()
    return docs.join(gone.hint("shuffle_hash"), (docs["doc_id"] == F.col(key)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(tag)), "left_anti")


# All pairs that share a shingle, counted; then what each document reaches. For small tables.
ORACLE_SQL = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end) g from w),
n as (select w.doc_id, count(g) n from w left join s using (doc_id) group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id a, doc_id b from n union select r.a, e.b from r join e on r.b = e.a)
select n.doc_id, n.n::bigint n_shingles, min(r.b)::bigint component_id from n join r on r.a = n.doc_id group by 1, 2"""
