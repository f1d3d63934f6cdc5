"""Cross-tokenizer alignment: groups of tokens of two vocabularies that cover the same bytes.

Space and text are tokenised by A (byte-level BPE) and B (sentence pieces with byte fallback). Every token points to its farthest-right
overlapping token; doubling the successors of all tokens at once (pointer jumping) ends at each group's terminal token, the A token after which
a B token ends too. Tokens with one terminal are a group.

Neither vocabulary joins anything across a blank that follows something visible, nor an ASCII letter with an ASCII sign or digit after it. So
texts are cut there on flat byte arrays, and each distinct piece is tokenised and grouped once and kept; the groups of
a text are those of its pieces in turn, and no link crosses a cut. ``Aligner`` checks B's pieces for this.

Corpus counts of linked pairs are exact: a row per text holds its distinct pairs, which are counted by partial aggregation. The most
frequent pairs, at most ``FREQUENT`` of them whatever the corpus, are broadcast to the texts; the others meet them by a shuffle, in which no pair holds
more than one in ``FREQUENT`` of the rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import stage, text_slices

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FREQUENT = 100_000
BLANK_MARK = "▁"
# Last bytes of Unicode white space, and the bytes before them.
_WHITE_LAST = [*range(0x80, 0x8B), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF, 0x85]
_WHITE_BEFORE = [0xC2, 0x80, 0x81, 0x9A, 0xA0]
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_HIGH_OK = np.zeros(256, bool)
_HIGH_OK[0x80:] = True
_HIGH_OK[_WHITE_LAST] = False
_NOT_BEFORE = np.ones(256, bool)
_NOT_BEFORE[_WHITE_BEFORE] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def jump(successor: np.ndarray) -> np.ndarray:
    """The terminal of every node: successors are doubled until none changes."""
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor
        successor = further


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Of each token, A's and then B's, the terminal A token of its group. Both cover the same bytes; ends are ascending."""
    n = len(ends_a)
    end = np.concatenate([ends_a, ends_b])
    over = np.concatenate([n + np.searchsorted(ends_b, ends_a - 1, "right"), np.searchsorted(ends_a, ends_b - 1, "right")])  # the other's token over the last byte
    itself = np.arange(len(end))
    farther = end[over] > end
    successor = np.where(farther, over, np.where(itself < n, itself, over))
    return jump(successor)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose bytes overlap."""
    begin = np.concatenate([[0], ends_a[:-1]]).astype(np.int64)
    first, last = np.searchsorted(ends_b, begin, "right"), np.searchsorted(ends_b, ends_a - 1, "right")
    many = last - first + 1
    a = np.repeat(np.arange(len(ends_a)), many)
    return a, np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(a))


def _spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Positions start[i] .. start[i] + many[i] - 1, one after the other."""
    return np.repeat(start - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


class Aligner:
    """Tokens, groups and links of texts by way of their distinct pieces."""

    KEEP, KEEP_BYTES, JOIN, SLICE = 1_000_000, 48 << 20, 1 << 16, 4 << 20

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that byte-level entries spell as they are; others follow from U+0100
        back = {chr(r): r for r in visible} | {chr(0x100 + k): r for k, r in enumerate(sorted(set(range(256)) - set(visible)))}
        names = [self.a.id_to_token(i) for i in range(max(self.a.get_vocab().values()) + 1)]
        self.bytes_a = [bytes(back[c] for c in x or "") for x in names]
        self.bytes_b = []
        seen = set()
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
                continue
            self.bytes_b.append(piece.replace(BLANK_MARK, " ").encode())
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                seen.update(zip(piece, piece[1:]))
        letter = lambda c: c.isascii() and c.isalpha()
        if any(y == BLANK_MARK != x or letter(x) and y.isascii() and not letter(y) for x, y in seen):
            raise ValueError("pieces that join a letter with a sign, or anything with a blank after it, don't suit this alignment")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_b)
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.spelt = pa.array([], pa.binary())
        self.counts = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, links, odd
        self.pairs = np.zeros(0, np.int64)

    def _both(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        text = raw.decode()
        fast = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        return np.array(fast([text], add_special_tokens=False)[0].ids, np.int64), np.array(self.b.encode(text[1:], num_threads=1), np.int64)

    def _learn(self, fresh: list[bytes], open_end: list[bool]) -> None:
        """Tokenise new pieces, many in one text: one of blanks alone or without a blank at its start follows " a", one that ends in white space is by itself."""
        strings = [p if p[:1] == b" " and not p.isspace() else b" a" + p for p in fresh]
        odd = [BLANK_MARK.encode() in p for p in fresh]
        counts = np.zeros((len(fresh), 5), np.int64)
        spelt, pairs = [b""] * len(fresh), [np.zeros(0, np.int64)] * len(fresh)

        def put(which: list[int]) -> None:
            raw = b"".join(strings[i] for i in which)
            ids_a, ids_b = self._both(raw)
            upto = np.cumsum([len(strings[i]) for i in which])
            ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
            same = b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) == raw == b"".join(map(self.bytes_b.__getitem__, ids_b.tolist()))
            if not same or not (np.isin(upto, ends_a).all() and np.isin(upto, ends_b).all()):
                if len(which) == 1:
                    odd[which[0]] = True
                else:
                    for i in which:
                        put([i])
                return
            terminal = groups(ends_a, ends_b)
            last, own = np.unique(terminal, return_inverse=True)
            n = len(ids_a)
            a, b = overlaps(ends_a, ends_b)
            link = ids_a[a] * self.width + ids_b[b]
            begin = upto - np.array([len(fresh[i]) for i in which])  # after the " a" that some follow
            from_a, to_a, from_b, to_b, from_l, to_l = (np.searchsorted(e, x, "right") for e in (ends_a, ends_b, ends_a[a]) for x in (begin, upto))
            text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
            cut_a, cut_b = (np.searchsorted(x, np.arange(len(last) + 1)).tolist() for x in (own[:n], own[n:]))
            said = [",".join(text_a[cut_a[g] : cut_a[g + 1]]) + "|" + ",".join(text_b[cut_b[g] : cut_b[g + 1]]) for g in range(len(last))]
            from_g, to_g = (np.searchsorted(ends_a[last], x, "right") for x in (begin, upto))
            counts[which, :4] = np.stack([to_a - from_a, to_b - from_b, to_g - from_g, to_l - from_l], 1)
            for i, g, h, x, y in zip(which, from_g.tolist(), to_g.tolist(), from_l.tolist(), to_l.tolist(), strict=True):
                spelt[i] = (";".join(said[g:h]) + ";").encode()
                pairs[i] = link[x:y]

        held: list[int] = []
        size = 0
        for i, s in enumerate(strings):
            if odd[i]:
                continue
            if open_end[i]:
                put([i])
                continue
            held.append(i)
            size += len(s)
            if size >= self.JOIN:
                put(held)
                held, size = [], 0
        if held:
            put(held)
        counts[:, 4] = odd
        self.known = pa.concat_arrays([self.known, pa.array(fresh, pa.binary())])
        self.spelt = pa.concat_arrays([self.spelt, pa.array(spelt, pa.binary())])
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, *pairs])

    def align(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice's texts: (A tokens, B tokens, groups, links; one row a text), hashes of the groups, and (text, pair, times) of its distinct linked pairs."""
        size = np.diff(offsets)
        filled = np.flatnonzero(size)
        data = np.insert(data, offsets[filled], 32)
        at = offsets + np.concatenate([[0], np.cumsum(size > 0)])
        n = len(data)
        none = np.zeros((len(size), 4), np.int64), [""] * len(size), *(np.zeros(0, np.int64) for _ in range(3))
        if not n:
            return none
        safe = _VISIBLE[data]
        safe[1:] |= _HIGH_OK[data[1:]] | (data[1:] >= 128) & _NOT_BEFORE[data[:-1]]
        letter = _LETTER[data]
        cut = np.zeros(n + 1, bool)
        cut[at] = True
        cut[1:n] |= (data[1:] == 32) & safe[:-1] | letter[:-1] & ~letter[1:] & (data[1:] < 128)
        starts = np.flatnonzero(cut).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        if len(self.known) > self.KEEP or self.known.nbytes + self.spelt.nbytes > self.KEEP_BYTES:
            self._forget()
        index = pieces.indices.to_numpy()
        code = pc.index_in(pieces.dictionary, value_set=self.known).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.isnan(code)) if code.dtype.kind == "f" else np.zeros(0, np.int64)
        code = np.nan_to_num(code).astype(np.int64)
        if len(new):
            code[new] = len(self.known) + np.arange(len(new))
            ends = np.empty(len(code), np.int64)
            ends[index[::-1]] = starts[1:][::-1]  # where each distinct piece first ends
            self._learn(pieces.dictionary.take(pa.array(new)).to_pylist(), (~safe[ends[new] - 1]).tolist())
        code = code[index]
        of = np.searchsorted(at, starts[:-1], "right") - 1
        totals = np.zeros((len(size), 5), np.int64)
        for k in range(5):
            totals[:, k] = np.bincount(of, self.counts[code, k], len(size))
        good = totals[:, 4] == 0
        totals[~good] = 0
        hashes = [""] * len(size)
        said = self.spelt.take(pa.array(code))
        ends, said = np.frombuffer(said.buffers()[1], np.int32), memoryview(said.buffers()[2] or b"")
        place = ends[np.searchsorted(starts, at)].tolist()
        for t in filled.tolist():
            if good[t]:
                hashes[t] = hashlib.sha256(said[place[t] : place[t + 1] - 1]).hexdigest()
        many = np.where(good[of], self.counts[code, 3], 0)
        begin = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
        key, times = np.unique(np.repeat(of, many) << 32 | self.pairs[_spread(begin[code], many)], return_counts=True)
        return totals[:, :4], hashes, key >> 32, key & 0xFFFFFFFF, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}  # one a worker process, kept between its tasks


def aligner(byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> Aligner:
    if (byte_bpe, piece_bpe) not in _ALIGNERS:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ALIGNERS[byte_bpe, piece_bpe] = Aligner(public_tokenizers.path(byte_bpe), public_tokenizers.path(piece_bpe))
    return _ALIGNERS[byte_bpe, piece_bpe]


NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
LINKS = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int32())]))


def _aligned(byte_bpe: str, piece_bpe: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_bpe, piece_bpe)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i, j, data, offsets in text_slices(batch, "text", Aligner.SLICE):
                totals, hashes, text, pair, times = both.align(data, offsets)
                cuts = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
                links = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([pa.array(pair), pa.array(times.astype(np.int32))], ["pair", "times"]))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + j - i)), batch.column(0).slice(i, j - i), *map(pa.array, totals.T.copy()), pa.array(hashes), links.cast(LINKS)], NAMES)
                row += j - i

    return run


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs(doc_id, text)``.

    Null and empty texts, and those that a vocabulary doesn't give back byte by byte (with U+2581), have no tokens: zeros and an
    empty groups_sha256. Rows that repeat a doc_id are documents of their own, each counted; a null doc_id stays null. Ties: all pairs with their
    A token's highest count are best. Further columns are ignored; empty input gives an empty result.
    """
    width = aligner(byte_bpe, piece_bpe).width
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<struct<pair:long,times:int>>"
    texts = stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_aligned(byte_bpe, piece_bpe), schema), "align-texts")
    each = texts.select("row", F.inline("links"))
    counts = stage(each.groupBy("pair").agg(F.count("*").alias("n")), "align-counts")
    highest = F.max("n").over(W.partitionBy(F.floor(F.col("pair") / width)))
    stats = counts.select("pair", "n", (F.col("n") == highest).alias("best"))
    least = (counts.agg(F.sum("n")).first()[0] or 0) // frequent
    stats = stage(stats, "align-stats")
    hot, cold = F.broadcast(stats.where(F.col("n") > least)), stats.where(F.col("n") <= least)
    best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    sums = each.join(hot, "pair").groupBy("row").agg(best, total)
    if least:
        rare = each.join(hot.select("pair"), "pair", "left_anti").join(cold, "pair").groupBy("row").agg(best, total)
        sums = sums.union(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return texts.drop("links").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256")
