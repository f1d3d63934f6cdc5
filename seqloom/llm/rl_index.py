"""Suffix-array deduplication with a run-length index: remove every byte that a 100-byte string covers which
also starts earlier in the corpus.

Routing. Every 100-byte window of a text is owned by its minimizer, the leftmost 16-byte string of least
hash in it, so equal windows are owned by equal minimizers at equal offsets. Consecutive windows with one
owner make a segment of at most 184 bytes. Segments meet by their minimizer's hash; equal ones of some
megabytes of text are reduced to the first before that, so a string that a third of all texts hold arrives once a
run. Of each minimizer with several segments, the bytes of the different ones are fetched. Window hashes then say
which windows to index, namely the first of those that occur again, and which to stream. They mark nothing.

Index. The windows to index, joined to strings where they overlap, are put into blocks of at most about ``BLOCK`` bytes. Of each block a run-compressed
Burrows-Wheeler transform is kept: run heads and starts, the LF images of the starts and text positions sampled at both ends of each run; the suffix array is
dropped. The later windows are streamed backwards through it. Matching statistics follow: within a run by LF, otherwise from the nearer sampled
run end by the length it has in common with the match so far, cut at 100. A window whose statistic is 100 is marked if the sampled place of its match lies
earlier. A segment that occurs again elsewhere is streamed once; what it matches marks its later copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import byte_table, mix64, powers, stage, text_slices

LENGTH = 100
KMER = 16
_P1, _P2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_T1, _T2 = byte_table(11), byte_table(12)
_MARK, _SEGMENT, _COPY = 0, 1, 2
_PIECE = 1 << 20
RUN = 1 << 23  # bytes of text whose equal segments are reduced to one
CHUNK = 1 << 21  # bytes of segments that are planned together
BLOCK = 1 << 18  # bytes of an index
TURN = 1 << 21  # windows that are worked on together
LAST = 2**63 - 1  # rows without an id come after all others, told apart by length and hash


def _prefix(data: np.ndarray, table: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(base, len(data)), out=out[1:])
    return out


def _range_hash(prefix: np.ndarray, base: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    back = powers(pow(base, -1, 2**64), len(prefix))
    return (prefix[b] - prefix[a]) * back[a]


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimizer hash, segment hash) of all segments of a slice."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    one = _prefix(data, _T1, _P1)
    m = len(data) - KMER + 1
    kmer = (one[KMER:] - one[:-KMER]) * powers(pow(_P1, -1, 2**64), len(one))[:m]
    kmer ^= kmer >> np.uint64(32)
    kmer *= np.uint64(0xBF58476D1CE4E5B9)
    del one
    low = _sliding_min((kmer & ~np.uint64((1 << 24) - 1)) | np.arange(m, dtype=np.uint64), LENGTH - KMER + 1)
    fits = np.ones(len(low), bool)
    for end in offsets[1:-1].tolist():  # windows that would run over a text's end
        fits[max(0, end - LENGTH + 1) : end] = False
    owner = (low & np.uint64((1 << 24) - 1)).astype(np.int32)
    change = owner[1:] != owner[:-1]
    new = fits.copy()
    new[1:] &= change | ~fits[:-1]
    first = np.flatnonzero(new)
    end = fits.copy()
    end[:-1] &= change | ~fits[1:]
    last = np.flatnonzero(end)
    n = last - first + 1
    two = _prefix(data, _T2, _P2)
    at = owner[first].astype(np.int64)
    seg = mix64(_range_hash(two, _P2, first, last + LENGTH) + (n.astype(np.uint64) << np.uint64(32)) + (at - first).astype(np.uint64))
    text = np.searchsorted(offsets, first, "right") - 1
    return text, first - offsets[text], n, kmer[at], seg


ROWS = "kind byte, doc long, tag long, a int, n int, k1 long, k2 long"


def _rows(kind, doc, tag, a, n, k1, k2) -> pa.RecordBatch:
    m = len(doc)
    cols = [np.full(m, kind, np.int8), doc.astype(np.int64), tag.astype(np.int64), a.astype(np.int32), n.astype(np.int32), k1.view(np.int64), k2.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "doc", "tag", "a", "n", "k1", "k2"])


def _first_of(keys: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are the first of their key by place in the corpus, rows that come later, for each of those its place among the first ones);
    a row that repeats the first one's place is neither."""
    order = np.lexsort((*place[::-1], *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    number = np.cumsum(new) - 1
    head = order[new][number]
    later = np.zeros(len(order), bool)
    for p in place:
        later |= p[order] != p[head]
    return order[new], order[later], number[later]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Slices of whole texts; a text of over _PIECE bytes in pieces that overlap by a window less one byte."""
    for i, j, data, offsets in text_slices(batch, "text"):
        if j - i > 1 or len(data) <= _PIECE:
            yield i, j, 0, data, offsets
            continue
        for s in range(0, len(data) - LENGTH + 1, _PIECE):
            part = data[s : s + _PIECE + LENGTH - 1]
            yield i, j, s, part, np.array([0, len(part)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each run of texts, equal ones once; marks of the others, which the index of the run decides."""
    held: list[tuple[np.ndarray, ...]] = []
    texts: list[np.ndarray] = []
    size = 0

    def reduced() -> Iterator[pa.RecordBatch]:
        doc, tag, a, n, k1, k2, at = (np.concatenate(x) for x in zip(*held, strict=True))
        data = np.concatenate(texts)
        once, again, number = _first_of([k1, k2], [doc, tag, a])
        twice = np.unique(number)
        first = once[twice]
        first = first[np.lexsort((a[first], tag[first], doc[first]))]
        raw = data.tobytes()
        whole = np.zeros(len(doc), bool)
        for part in _chunks(k1[first], n[first] + LENGTH - 1):
            own = np.sort(part)  # in the corpus' order again
            f = first[own]
            strings = [raw[x:y] for x, y in zip(at[f].tolist(), (at[f] + n[f] + LENGTH - 1).tolist(), strict=True)]
            found = long_matches(strings, k1[f], np.ones(len(f), bool))
            whole[f] = np.bincount(found[0], minlength=len(f)) == n[f]
        sure = whole[once[number]]
        done, more = again[sure], again[~sure]
        yield _rows(_MARK, doc[done], tag[done], a[done], n[done], mix64(doc[done].view(np.uint64)), k2[done])
        keep = np.concatenate([once, more])
        yield _rows(_SEGMENT, doc[keep], tag[keep], a[keep], n[keep], k1[keep], k2[keep])

    for batch in batches:
        ids, tags = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
        for i, _, shift, data, offsets in _pieces(batch):
            text, a, n, k1, k2 = segments(data, offsets)
            if not len(text):
                continue
            held.append((ids[i + text], tags[i + text], a + shift, n, k1, k2, size + offsets[text] + a))
            texts.append(data)
            size += len(data)
            if size >= RUN:
                yield from reduced()
                held, texts, size = [], [], 0
    if held:
        yield from reduced()


def _chunks(group: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of whole groups, about CHUNK bytes together."""
    order = np.argsort(group, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]])[: len(order)])
    upto = np.cumsum(size[order])
    begin = 0
    while begin < len(order):
        want = np.searchsorted(upto, (upto[begin - 1] if begin else 0) + CHUNK)
        k = np.searchsorted(heads, want, "right") if want < len(order) else len(heads)
        end = int(heads[k]) if k < len(heads) else len(order)
        yield order[begin:end]
        begin = end


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of minimizers in several places: the first of each different segment, and copies of those. Rows come in order of k1."""
    for table in _by_minimizer(batches, 1 << 18):
        mark = table.column("kind").to_numpy() == _MARK
        if mark.any():
            yield from table.filter(pa.array(mark)).to_batches()
            table = table.filter(pa.array(~mark))
        doc, tag, a, n, k1, k2 = (table.column(c).to_numpy() for c in ("doc", "tag", "a", "n", "k1", "k2"))
        same = np.zeros(len(k1) + 1, bool)
        order = np.argsort(k1, kind="stable")
        s = k1[order]
        same[1:-1] = s[1:] == s[:-1]
        order = order[same[:-1] | same[1:]]
        doc, tag, a, n, k1, k2 = (x[order] for x in (doc, tag, a, n, k1, k2))
        once, again, _ = _first_of([k1, k2], [doc, tag, a])
        several = np.isin(k1[once], k1[again]) | np.isin(k1[once], _repeated(k1[once]))
        once = once[several]
        yield _rows(_COPY, doc[again], tag[again], a[again], n[again], k1[again], k2[again])
        yield _rows(_SEGMENT, doc[once], tag[once], a[once], n[once], k1[once], k2[once])


def _repeated(x: np.ndarray) -> np.ndarray:
    s = np.sort(x)
    return s[1:][s[1:] == s[:-1]]


def _by_minimizer(batches: Iterator[pa.RecordBatch], rows: int, size: int | None = None) -> Iterator[pa.Table]:
    """Tables of whole minimizers, of about ``rows`` rows or ``size`` bytes, from batches in order of k1."""
    held: list[pa.RecordBatch] = []
    many = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        k1 = batch.column(batch.schema.get_field_index("k1")).to_numpy()
        if held and (many >= rows or size and sum(b.nbytes for b in held) >= size):
            end = int(np.searchsorted(k1, held[-1].column(held[-1].schema.get_field_index("k1"))[-1].as_py(), "right"))
            if end < batch.num_rows:
                held.append(batch.slice(0, end))
                yield _taken(held)
                many, batch = 0, batch.slice(end)
        held.append(batch)
        many += batch.num_rows
    if held:
        yield _taken(held)


def _taken(held: list[pa.RecordBatch]) -> pa.Table:
    """The batches as a table that only its receiver holds."""
    table = pa.Table.from_batches(held)
    held.clear()
    return table


class RunLengthIndex:
    """Run-compressed BWT of strings, each followed by a terminator that sorts before all bytes, earlier ones first.

    Kept: the text, run heads and starts, the LF image of each run's start, and text positions sampled at the first and last row
    of each run. The suffix array itself is not kept.
    """

    def __init__(self, strings: list[bytes], depth: int = LENGTH):
        size = np.array([len(s) for s in strings], np.int64)
        self.depth = depth
        self.ends = np.cumsum(size + 1) - 1
        symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
        symbols[self.ends] = 0
        n = len(symbols)
        left = np.repeat(self.ends, size + 1) - np.arange(n)  # symbols before the terminator
        sa = self._sort(symbols, left, int(size.max(initial=0)) + 1)
        self.text = np.concatenate([symbols, np.zeros(depth + 16, np.int64)]).astype(np.uint16)
        bwt = symbols[sa - 1]
        starts = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.run_start, self.run_head = starts, bwt[starts]
        run_end = np.append(starts[1:], n)
        by_head = np.argsort(self.run_head, kind="stable")
        self.lf_base = np.empty(len(starts), np.int64)
        self.lf_base[by_head] = np.concatenate([[0], np.cumsum((run_end - starts)[by_head])[:-1]])
        self.first_sample, self.last_sample = sa[starts], sa[run_end - 1]
        self.run_end = run_end - 1
        self.by_head = by_head
        self.head_key = self.run_head[by_head] * len(starts) + by_head  # to find the next run of a head
        self.rows = n

    @staticmethod
    def _sort(symbols: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
        """The suffix array: suffixes by their symbols up to the terminator, equal ones by place. Doubling; what is settled isn't sorted again."""
        n = len(symbols)
        at = np.arange(n)
        key = np.zeros(n, np.int64)
        for j in range(7):
            key = key * 257 + np.where(j <= left, symbols[np.minimum(at + j, n - 1)], 0)
        order = np.argsort(key)
        slots, step = at, 7
        rank = np.empty(n, np.int64)
        sub, value = order, key[order]
        while True:
            new = np.concatenate([[True], value[1:] != value[:-1]])
            rank[sub] = slots[np.maximum.accumulate(np.where(new, np.arange(len(sub)), 0))]
            open_ = ~(new & np.append(new[1:], True))
            slots, sub = slots[open_], sub[open_]
            if not len(slots):
                return order
            if step >= longest:
                by = np.lexsort((sub, rank[sub]))
                order[slots] = sub[by]
                return order
            value = rank[sub] * (n + 1) + np.where(left[sub] >= step, rank[np.minimum(sub + step, n - 1)] + 1, 0)
            by = np.argsort(value)
            sub, value = sub[by], value[by]
            order[slots] = sub
            step *= 2

    def back(self, row: np.ndarray) -> np.ndarray:
        """LF: the rows of the suffixes one symbol to the left."""
        run = np.searchsorted(self.run_start, row, "right") - 1
        return self.lf_base[run] + row - self.run_start[run]

    def _common(self, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Symbols that the texts from p and q on have in common, at most ``most``."""
        out = np.zeros(len(p), np.int64)
        live, lane = np.arange(len(p)), np.arange(16)
        for at in range(0, self.depth, 16):
            same = self.text[(p[live] + at)[:, None] + lane] == self.text[(q[live] + at)[:, None] + lane]
            full = same.all(1)
            out[live] += np.where(full, 16, same.argmin(1))
            live = live[full & (out[live] < most[live])]
            if not len(live):
                break
        return np.minimum(out, most)

    def statistics(self, patterns: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Stream patterns backwards: (pattern, position, length of its longest match cut at ``depth``, place of that match)."""
        size = np.array([len(s) for s in patterns], np.int64)
        data = np.frombuffer(b"".join(patterns), np.uint8)
        end = np.cumsum(size)
        live = np.argsort(-size, kind="stable")
        row, place, length = np.zeros(len(size), np.int64), np.full(len(size), self.first_sample[0]), np.zeros(len(size), np.int64)
        runs = len(self.run_start)
        for back in range(1, int(size.max(initial=0)) + 1):
            some = int(np.searchsorted(-size[live], -back, "right"))
            live, row, place, length = live[:some], row[:some], place[:some], length[:some]
            c = data[end[live] - back].astype(np.int64) + 1
            run = np.searchsorted(self.run_start, row, "right") - 1
            absent = np.zeros(some, bool)
            turn = np.flatnonzero(self.run_head[run] != c)
            if len(turn):
                k = np.searchsorted(self.head_key, c[turn] * runs + run[turn])
                above, below = self.by_head[np.maximum(k - 1, 0)], self.by_head[np.minimum(k, runs - 1)]
                up, down = self.last_sample[above], self.first_sample[below]
                best = [np.where(self.run_head[r] == c[turn], self._common(place[turn], q, length[turn]), -1) for r, q in ((above, up), (below, down))]
                first = best[0] >= best[1]
                run[turn] = np.where(first, above, below)
                row[turn] = np.where(first, self.run_end[above], self.run_start[below])
                place[turn] = np.where(first, up, down)
                length[turn] = np.maximum(*best)
                absent[turn] = length[turn] < 0
            row = np.where(absent, 0, self.lf_base[run] + row - self.run_start[run])
            place = np.where(absent, self.first_sample[0], place - 1)
            length = np.where(absent, 0, np.minimum(length + 1, self.depth))
            yield live, size[live] - back, length, place


def _joined(which: np.ndarray, string: np.ndarray, at: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) of maximal runs of neighbouring windows of a string in one block."""
    new = np.ones(len(which), bool)
    new[1:] = (string[which][1:] != string[which][:-1]) | (at[which][1:] != at[which][:-1] + 1) | (block[which][1:] != block[which][:-1])
    first = np.flatnonzero(new)
    return which[first], np.diff(np.append(first, len(which)))


def _windows(strings: list[bytes], turn: int, turns: int) -> tuple[np.ndarray, ...]:
    """(string, place in it, hash) of the windows of one turn, which takes a share of all hashes; some megabytes are hashed at a time."""
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    size = np.array([len(s) for s in strings], np.int64)
    upto = np.cumsum(size)
    low = 0
    while low < len(strings):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + CHUNK, "right")))
        own = size[low:high]
        n = own - LENGTH + 1
        string = np.repeat(np.arange(high - low), n)
        at = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
        start = (np.cumsum(own) - own)[string] + at
        key = mix64(_range_hash(_prefix(np.frombuffer(b"".join(strings[low:high]), np.uint8), _T2, _P2), _P2, start, start + LENGTH))
        if turns > 1:
            some = np.flatnonzero((key >> np.uint64(40)) % np.uint64(turns) == turn)
            string, at, key = string[some], at[some], key[some]
        found.append((string + low, at, key))
        low = high
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def matches(strings: list[bytes], group: np.ndarray, copied: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(string, window, string of its match) of windows with a match of at least 100 bytes; the match is at the first string that holds it.

    ``strings`` come in the order of the corpus, and only those of one ``group`` can have windows in common. All windows of ``copied`` ones are
    streamed, of the others those that also start earlier. Windows are worked on ``TURN`` at a time, by their hashes, so that equal ones meet: beside the strings themselves a turn's
    memory is bounded.
    """
    _, of = np.unique(group, return_inverse=True)
    groups = int(of.max()) + 1 if len(of) else 0
    turns = max(1, -(-sum(len(s) - LENGTH + 1 for s in strings) // TURN))
    for turn in range(turns):
        string, at, key = _windows(strings, turn, turns)
        order = np.argsort(key)
        heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])[: len(order)])
        many = np.diff(np.append(heads, len(order)))
        first = np.zeros(len(order), np.int64)
        if len(order):
            first[order] = np.repeat(np.minimum.reduceat(order, heads), many)
        again = first != np.arange(len(first))
        wanted = np.zeros(len(first), bool)
        stream = again | copied[string]
        wanted[first[stream]] = True
        del order, heads, many, first, again
        # blocks: whole groups one after the other; a group that alone outgrows a block is dealt by the windows' hashes
        runs, _ = _joined(np.flatnonzero(wanted), string, at, np.zeros(len(string), np.int64))
        windows, weight = np.bincount(of[string], wanted, groups), np.bincount(of[string[runs]], minlength=groups) * (LENGTH - 1.0)
        weight += windows
        parts = np.where(weight > BLOCK, np.ceil(windows * LENGTH / BLOCK), 1).astype(np.int64)
        upto = np.cumsum(np.where(parts > 1, BLOCK, weight))
        base = (upto // BLOCK).astype(np.int64) + np.concatenate([[0], np.cumsum(parts - 1)[:-1]]).astype(np.int64)
        block = base[of[string]] + (key % parts[of[string]].astype(np.uint64)).astype(np.int64)
        sides = []
        for mask in (wanted, stream):
            w, m = _joined(np.flatnonzero(mask), string, at, block)
            by = np.argsort(block[w], kind="stable")
            sides.append((w[by], m[by]))
        (iw, im), (pw, pm) = sides
        cut = lambda w, m: [strings[s][x : x + k + LENGTH - 1] for s, x, k in zip(string[w].tolist(), at[w].tolist(), m.tolist(), strict=True)]  # noqa: B023, E731
        for b in np.unique(block[pw]):
            x, y = (slice(*np.searchsorted(block[w], (b, b + 1))) for w in (iw, pw))
            index = RunLengthIndex(cut(iw[x], im[x]))
            owner = string[iw[x]]
            out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
            for which, where, length, place in index.statistics(cut(pw[y], pm[y])):
                hit = length >= LENGTH
                if hit.any():
                    w = pw[y][which[hit]] + where[hit]
                    out.append((string[w], at[w], owner[np.searchsorted(index.ends, place[hit])]))
            yield tuple(map(np.concatenate, zip(*out, strict=True)))


def long_matches(strings: list[bytes], group: np.ndarray, copied: np.ndarray) -> tuple[np.ndarray, ...]:
    """All that ``matches`` finds, of few strings."""
    return tuple(map(np.concatenate, zip((np.zeros(0, np.int64),) * 3, *matches(strings, group, copied), strict=True)))


def _marked(strings: list[bytes], group: np.ndarray, copied: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether each string is matched whole, a bit for each window that an earlier string holds, first window of each string)."""
    n = np.array([len(s) - LENGTH + 1 for s in strings], np.int64)
    begin = np.cumsum(n) - n
    hits, marked = np.zeros(len(strings), np.int64), np.zeros(int(n.sum()), bool)
    for s, w, match in matches(strings, group, copied):
        hits += np.bincount(s, minlength=len(strings))
        earlier = match < s
        marked[begin[s[earlier]] + w[earlier]] = True
    return hits == n, marked, begin


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from the run-length index over the segments of one partition, whole minimizers at a time."""
    for table in _by_minimizer(batches, 1 << 20, CHUNK):
        bare = table.column("piece").is_null().to_numpy()
        doc, tag, a, n, k1, k2 = (table.column(c).to_numpy() for c in ("doc", "tag", "a", "n", "k1", "k2"))
        order = np.lexsort((k1, a, tag, doc))
        order = order[~bare[order]]
        new = np.ones(len(order), bool)  # rows that repeat a text fetch its segments again
        for c in (k1, a, tag, doc):
            new[1:] &= c[order][1:] == c[order][:-1]
        new[1:] = ~new[1:]
        order = order[new]
        if not len(order):
            continue
        strings = table.column("piece").take(pa.array(order)).to_pylist()
        del table
        name = mix64(k1.view(np.uint64)) ^ k2.view(np.uint64)
        copies = np.flatnonzero(bare)
        by = np.argsort(name[order])
        of = by[np.minimum(np.searchsorted(name[order][by], name[copies]), len(by) - 1)]
        copied = np.zeros(len(order), bool)
        copied[of] = True
        whole, marked, begin = _marked(strings, k1[order], copied)
        sure = copies[whole[of]]
        yield _rows(_MARK, doc[sure], tag[sure], a[sure], n[sure], k1[sure], k2[sure])
        for low in range(0, len(order), 1 << 16):
            high = min(low + (1 << 16), len(order))
            w = np.flatnonzero(marked[begin[low] : begin[high] if high < len(order) else len(marked)]) + begin[low]
            s = np.searchsorted(begin, w, "right") - 1
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1] + 1)
            head = np.flatnonzero(new)
            r = order[s[head]]
            yield _rows(_MARK, doc[r], tag[r], a[r] + w[head] - begin[s[head]], np.diff(np.append(head, len(s))), k1[r], k2[r])


PIECES = "doc long, tag long, a int, n int, k1 long, k2 long, piece binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        doc, tag, rows, piece = [], [], [], []
        for d, t, text, want in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            raw = text.encode()
            doc += [d] * len(want)
            tag += [t] * len(want)
            rows += [(w["a"], w["n"], w["k1"], w["k2"]) for w in want]
            piece += [raw[w["a"] : w["a"] + w["n"] - 1 + LENGTH] for w in want]
        a, n, k1, k2 = zip(*rows, strict=True) if rows else ([],) * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((doc, tag, a, n, k1, k2, piece), kinds, strict=True)], ["doc", "tag", "a", "n", "k1", "k2", "piece"])


def union_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    first = np.flatnonzero(new)
    return s[first], e[np.append(first[1:], len(s)) - 1] if len(s) else e


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for d, text, marks in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            raw = (text or "").encode()
            s = np.array([m["a"] for m in marks or ()], np.int64)
            e = s + np.array([m["n"] for m in marks or ()], np.int64) - 1 + LENGTH
            s, e = union_of(s, e)
            kept = b"".join(raw[x:y] for x, y in zip(np.append(0, e), np.append(s, len(raw)), strict=True))
            out.append((d, len(raw), len(raw) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), [{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)]))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ``spans`` of every row.

    Null texts are empty; texts under 100 bytes lose nothing by themselves. Documents are ordered by doc_id and, where rows with different texts
    share one, by the text's 64-bit hash; rows without an id come last, longer texts first. Rows that repeat a doc_id with its text are one document and share its
    result. Further columns are ignored; empty input gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    unnamed = F.col("doc_id").isNull()
    tag = F.xxhash64(text).bitwiseAND(F.lit(-2)).bitwiseOR(unnamed.cast("long")).alias("tag")  # the last bit says that there is no id
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST) - F.octet_length(text)).alias("doc"), tag, text.alias("text"))  # both joins read this one exchange
    cut = docs.mapInArrow(_cut, ROWS).repartition("k1").sortWithinPartitions("k1")
    found = stage(cut.mapInArrow(_meet, ROWS), "rl-meet")
    key = ["doc", "tag"]
    wanted = found.where(F.col("kind") == _SEGMENT).groupBy(*key).agg(F.collect_list(F.struct("a", "n", "k1", "k2")).alias("want"))
    pieces = docs.join(wanted.hint("shuffle_hash"), key).select(*key, "text", "want").mapInArrow(_fetch, PIECES)
    copies = found.where(F.col("kind") == _COPY).select(*key, "a", "n", "k1", "k2", F.lit(None).cast("binary").alias("piece"))
    streamed = pieces.union(copies).repartition("k1").sortWithinPartitions("k1").mapInArrow(_stream, ROWS)
    marks = found.where(F.col("kind") == _MARK).union(streamed).groupBy(*key).agg(F.collect_list(F.struct("a", "n")).alias("marks"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    name = F.when(F.col("tag").bitwiseAND(F.lit(1)) == 0, F.col("doc"))
    return docs.join(marks.hint("shuffle_hash"), key, "left").select(name.alias("doc_id"), "text", "marks").mapInArrow(_finish, schema)
