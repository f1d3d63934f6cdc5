"""Cost-balanced packing of documents into training sequences.

A document of l tokens costs ``linear`` * l + ``quadratic`` * l**2 (projection and attention). Documents are
gathered into bounded blocks in the order a task reads them; in a block the documents go, costliest first,
to the sequence of least cost that still has room. The block's sequences have exactly the block's tokens
as capacity: whole windows, and for what is left over windows of powers of two, which are not padded. A
document longer than a window fills windows of its own first; one that fits nowhere is cut over
the sequences of least cost. No shuffle is needed, no block outgrows ``block`` tokens plus one document, and a
task that is run again gives the same sequences, whose ids hold the partition and a running number.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import text_slices

WINDOW = 4096
END = 2
# Letters folded to lower case and line ends to blanks.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[10] = 32
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(tokens: int, window: int) -> np.ndarray:
    """Sequence lengths that sum to ``tokens``: whole windows, then the powers of two of the rest."""
    rest = tokens % window
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([window] * (tokens // window) + tail, np.int64)


def pack(lengths: np.ndarray, window: int = WINDOW, linear: float = 1.0, quadratic: float = 1 / 1024) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block."""
    room = capacities(int(lengths.sum()), window)
    cost, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
    pieces = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, int(used[seq])))
        used[seq] += n
        room[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    done = np.zeros(len(lengths), np.int64)
    seq = 0
    for doc in np.flatnonzero(lengths >= window):
        while lengths[doc] - done[doc] >= window:
            put(int(doc), int(done[doc]), window, seq)
            done[doc] += window
            seq += 1
    rest = lengths - done
    for doc in np.argsort(-rest, kind="stable"):
        n = int(rest[doc])
        if n < 2:
            break
        fits = np.where(room >= n, cost, np.inf)
        best = int(np.argmin(fits))
        if np.isfinite(fits[best]):
            put(int(doc), int(done[doc]), n, best)
            continue
        for best in np.lexsort((cost, room == 0)):
            m = min(n, int(room[best]))
            if not m:
                break
            put(int(doc), int(done[doc]), m, int(best))
            done[doc] += m
            n -= m
            if not n:
                break
    return pieces + _single(np.flatnonzero(rest == 1), lengths, room, cost, used, linear + quadratic)


def _single(docs: np.ndarray, lengths: np.ndarray, room: np.ndarray, cost: np.ndarray, used: np.ndarray, step: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces of what is left as one token of each document, all at once: places are taken by what their sequence costs before, then by sequence."""
    seq = np.repeat(np.arange(len(room)), room)
    nth = np.arange(len(seq)) - np.repeat(np.cumsum(room) - room, room)
    order = np.lexsort((seq, cost[seq] + nth * step))[: len(docs)]
    columns = docs, lengths[docs] - 1, np.ones(len(docs), np.int64), seq[order], used[seq[order]] + nth[order]
    return list(zip(*(c.tolist() for c in columns), strict=True))


class WordCodec:
    """Token ids of whole texts: texts are cut into pieces, and each distinct piece is encoded once and kept with its ids.

    The vocabulary lower-cases, drops white space and never joins anything across it, nor a letter with an ASCII mark or digit
    that follows. So the ids of a text are those of its pieces in turn, where a piece starts with blanks or where
    an ASCII letter is followed by another ASCII character. Pieces are found on flat byte arrays and looked up as Arrow
    arrays. New pieces of letters alone go to the vocabulary's merges, the others to the whole
    tokenizer, many together with a mark between them that none of them holds. Texts that hold the opening of a special token's name
    are encoded plainly. What is kept is emptied at ``keep`` pieces or ``KEEP_BYTES`` bytes.
    """

    MARK = "~"
    OPENING = b"<|"
    LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # as they are after normalisation: a-z and the small letters of Latin-1
    MOST, KEEP_BYTES = 8 << 20, 32 << 20
    PROBES = ("The Quick  brown\n\nfox's 12,345.6 can't", " lead and trail \t ", "a-b_c(d)e~f ~ 1st x2y", "\u00c4\u00d6 na\u00efve e\u0301 \u4e2d\u6587 \u65e5\u672c \U0001f600.", "HTTP://Some.Where/a?b=c&d")

    def __init__(self, path: str, keep: int = 1_000_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        spelling = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {c: spelling.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.keep = keep
        marks = self._ids(self.MARK)
        if len(marks) != 1 or self.merges.__class__.__name__ != "BPE":
            raise ValueError(f"{path} doesn't suit WordCodec: it has to be a byte-pair vocabulary with {self.MARK} as one entry")
        self.mark = int(marks[0])
        self._forget()
        if not all(map(self._suits, self.PROBES)):
            raise ValueError(f"{path} doesn't suit WordCodec: it has to lower-case, drop white space and join nothing across it")
        self._forget()

    def _suits(self, text: str) -> bool:
        """Whether a probe's pieces give the ids of the whole; other rules also show in ids that don't part at the mark."""
        raw = np.frombuffer(text.encode(), np.uint8)
        try:
            return np.array_equal(self.encode(raw, np.array([0, len(raw)]))[0], self._ids(text))
        except ValueError:
            return False

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as bytes."""
        out: list[bytes] = [b""] * len(pieces)
        mixed = []
        letters, merges, spelt = self.LETTERS.fullmatch, self.merges.tokenize, self.spelt
        for i, raw in enumerate(pieces):
            if raw.isalpha():
                out[i] = array("I", [t.id for t in merges(raw.decode())]).tobytes()
            elif letters(raw):
                out[i] = array("I", [t.id for t in merges(raw.decode().translate(spelt))]).tobytes()
            elif b"~" in raw:
                out[i] = self._ids(raw.decode()).tobytes()
            else:
                mixed.append(i)
        parts = [mixed[i : i + 2000] for i in range(0, len(mixed), 2000)]
        fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for part, e in zip(parts, fast([f" {self.MARK} ".join(pieces[i].decode() for i in p) for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            raw = ids.tobytes()
            at = 0
            for i, end in zip(part, [*(np.flatnonzero(ids == self.mark) * 4).tolist(), len(raw)], strict=True):
                out[i] = raw[at:end]
                at = end + 4
        return out

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each of the distinct pieces is among those known; new ones are encoded and added."""
        at = pc.index_in(pieces, value_set=self.known).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.isnan(at)) if at.dtype.kind == "f" else np.zeros(0, np.int64)
        at = np.nan_to_num(at).astype(np.int64)
        if len(new):
            at[new] = len(self.known) + np.arange(len(new))
            fresh = pieces.take(pa.array(new))
            ids = self._encoded([p.strip() for p in fresh.to_pylist()])
            self.known = pa.concat_arrays([self.known, fresh])
            self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids)) // 4])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        return at

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        folded = _FOLD[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if n:
            blank, letter = folded == 32, (folded >= 97) & (folded <= 122)
            cut[1:n] |= blank[1:] & ~blank[:-1] | letter[:-1] & ~letter[1:] & (folded[1:] < 128)
        starts = np.flatnonzero(cut).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(folded)]).dictionary_encode()
        if len(self.known) > self.keep or self.known.nbytes > self.KEEP_BYTES:
            self._forget()
        code = self._places(pieces.dictionary)[pieces.indices.to_numpy()]
        many = self.size[code]
        at = np.concatenate([[0], np.cumsum(many)])
        flat = self.flat[np.repeat((np.cumsum(self.size) - self.size)[code] - at[:-1], many) + np.arange(at[-1])]
        return flat, at[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice, offsets of each text's ids); a very long text is worked on in parts that end at blanks."""
        if self.OPENING in memoryview(data).tobytes():
            parts = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                raw = data[a:b].tobytes()
                parts.append(self._ids(raw.decode()) if self.OPENING in raw else self._whole(data[a:b]))
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        if len(offsets) == 2:
            ids = self._whole(data)
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _whole(self, data: np.ndarray) -> np.ndarray:
        parts, at = [np.zeros(0, "<u4")], 0
        while at < len(data):
            end = at + self.MOST
            if end < len(data):
                blanks = np.flatnonzero(_FOLD[data[at:end]] == 32)
                more = np.flatnonzero(_FOLD[data[end:]] == 32) if not len(blanks) else blanks
                end = at + int(blanks[-1]) + 1 if len(blanks) else end + int(more[0]) + 1 if len(more) else len(data)
            part = data[at : min(end, len(data))]
            parts.append(self._encode(part, np.array([0, len(part)]))[0])
            at += len(part)
        return np.concatenate(parts)


_CODECS: dict[str, WordCodec] = {}  # one a worker process, kept between its tasks


def codec(vocabulary: str) -> WordCodec:
    if vocabulary not in _CODECS:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _CODECS[vocabulary] = WordCodec(public_tokenizers.path(vocabulary))
    return _CODECS[vocabulary]


def _packer(vocabulary: str, window: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        base = TaskContext.get().partitionId() << 32
        made = 0
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            lengths = np.array([len(t) for t in tokens], np.int64)
            rows = [
                (ids[d], start, n, zlib.crc32(tokens[d][start : start + n].tobytes()), len(tokens[d]), base + made + seq, offset)
                for d, start, n, seq, offset in pack(lengths, window)
            ]
            made += len(capacities(int(lengths.sum()), window))
            ids.clear()
            tokens.clear()
            held = 0
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        end = np.array([END], "<u4")
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, j, data, offsets in text_slices(batch, "text", WordCodec.MOST):
                flat, at = words.encode(data, offsets)
                for key, a, b in zip(keys[i:j], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    ids.append(key)
                    tokens.append(np.concatenate([flat[a:b], end]))
                    held += b - a + 1
                    if held >= block:
                        yield flush()
        if tokens:
            yield flush()

    return run


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", window: int = WINDOW, block: int = 1 << 21) -> DataFrame:
    """Pieces of all ``docs(doc_id, text)``: every token lies in exactly one piece.

    Null and empty texts are the end token alone. Rows that repeat a doc_id are documents of their own;
    a null doc_id stays null. Ties in cost go to the earlier document and sequence. Empty input gives
    no piece; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_packer(vocabulary, window, block), SCHEMA)
