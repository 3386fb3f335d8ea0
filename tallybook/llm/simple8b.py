"""Token ids in Simple-8b files.

``encode_documents`` tokenises whole texts, appends the end id and writes the ids
in ascending ``doc_id`` order as a directory of Parquet files that hold binary
segments (Parquet is only the container: it gives atomic commits and works on
every store Spark can write).  ``decode_documents`` reads the segments back.

A segment holds whole consecutive documents and is self-describing.  Layout, all
little endian::

    magic 'S8B1' | u32 documents | u32 blocks | u32 ids per block
    u64 ids | u64 words
    u32 x documents : ids of each document
    u32 x (blocks+1): word offset of each block (words may be decoded from any block)
    u64 x words     : Simple-8b words

A word has a 4-bit selector (top bits) and 60 data bits, the first id lowest.
Selectors 2..15 pack 60,30,20,15,12,10,8,7,6,5,4,3,2,1 ids of
1,2,3,4,5,6,7,8,10,12,15,20,30,60 bits; selector 1 is a run of 120 zeros;
selector 0 is an escape: the next word is one raw 64-bit value, so any unsigned
64-bit id can be stored.  Blocks hold ``BLOCK`` ids and start on a word.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` sorts
first; rows with equal ``doc_id`` are all written, ordered by text; no rows give
no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import Scratch, pick, same, shuffle_partitions
from .words import LOWER, NOT_SPACE, SPACE, U, Words, pieces, text_bytes

BLOCK = 1024
SEGMENT_IDS = 1 << 18
MAGIC = b"S8B1"
#: Fixed values of the coding: (ids per word, bits per id) of selectors 2..15.
LAYOUT = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ZERO_RUN = 120


# ------------------------------------------------------------------ coding
def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id (0 for zero)."""
    out = np.zeros(len(ids), np.uint8)
    small = ids < U(1 << 32)
    out[small] = np.frexp(ids[small].astype(np.float64))[1]
    big = ids[~small]
    out[~small] = 32 + np.frexp((big >> U(32)).astype(np.float64))[1]
    return out


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, block word offsets) of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, U)
    n = len(ids)
    n_blocks = -(-n // block)
    if not n:
        return np.zeros(0, U), np.zeros(1, np.uint32)
    # Every block is padded with zeros, so that a window never looks into the next one.
    pad = ZERO_RUN
    grid = np.zeros((n_blocks, block + pad), U)
    grid[: n // block, :block] = ids[: n // block * block].reshape(-1, block)
    grid[-1, : n - (n_blocks - 1) * block] = ids[(n_blocks - 1) * block :]
    flat = grid.reshape(-1)
    w = _widths(flat).reshape(n_blocks, block + pad)
    # Widest id in the window of c ids starting at each place, for growing c.
    sel = np.zeros((n_blocks, block), np.uint8)  # 0: escape
    widest, have = w.copy(), 1
    for s in range(15, 1, -1):
        c, bits = LAYOUT[s - 2]
        widest, have = _widen(w, widest, have, c)
        sel[widest[:, :block] <= bits] = s
    widest, _ = _widen(w, widest, have, ZERO_RUN)
    sel[widest[:, :block] == 0] = 1
    counts = np.array([1, ZERO_RUN, *(c for c, _ in LAYOUT)], np.int64)
    step = counts[sel]
    # Follow the chain of word starts in all blocks at once.
    rows = np.arange(n_blocks)
    steps, at = step.reshape(-1), rows * block
    ends = np.minimum(at + block, n)
    found = []
    while len(at):
        found.append(at)
        at = at + steps[at]
        go = at < ends
        at, ends = at[go], ends[go]
    spot = np.sort(np.concatenate(found))
    row, place = spot // block, spot % block
    chosen = sel[row, place]
    cost = 1 + (chosen == 0)
    out_at = np.cumsum(cost) - cost
    words = np.zeros(int(cost.sum()), U)
    base = row * (block + pad) + place
    for s in range(2, 16):
        c, bits = LAYOUT[s - 2]
        k = np.flatnonzero(chosen == s)
        if len(k):
            acc = np.full(len(k), U(s) << U(60), U)
            for j in range(c):
                acc |= flat[base[k] + j] << U(j * bits)
            words[out_at[k]] = acc
    words[out_at[chosen == 1]] = U(1) << U(60)
    k = np.flatnonzero(chosen == 0)
    words[out_at[k] + 1] = flat[base[k]]
    per_block = np.bincount(row, weights=cost, minlength=n_blocks).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)


def _widen(w: np.ndarray, widest: np.ndarray, have: int, want: int) -> tuple[np.ndarray, int]:
    """From the maximum over ``have`` places to that over ``want`` (have <= want)."""
    while have < want:
        shift = min(have, want - have)
        nxt = widest.copy()
        np.maximum(nxt[:, :-shift], widest[:, shift:], out=nxt[:, :-shift])
        widest, have = nxt, have + shift
    return widest, have


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids again; all words of one selector are decoded together."""
    if not n:
        return np.zeros(0, U)
    sel = (words >> U(60)).astype(np.int64)
    counts = np.array([1, ZERO_RUN, *(c for c, _ in LAYOUT)], np.int64)
    # A raw word follows each escape; escapes are found left to right as a raw word may look like one.
    raw = np.zeros(len(words), bool)
    zero = np.flatnonzero(sel == 0)
    i = 0
    while i < len(zero):
        if not raw[zero[i]]:
            raw[zero[i] + 1] = True
        i += 1
    head = np.flatnonzero(~raw)
    sel = sel[head]
    per = counts[sel]
    # Cut each block's last word to the ids that are left.
    block_of = np.searchsorted(offsets.astype(np.int64), head, "right") - 1
    start = np.cumsum(per) - per
    first = np.concatenate([[True], block_of[1:] != block_of[:-1]])
    start = start - np.repeat(start[first], np.diff(np.append(np.flatnonzero(first), len(head)))) + block_of * block
    out = np.zeros((len(offsets) - 1) * block + ZERO_RUN, U)
    for s in range(15, 1, -1):
        c, bits = LAYOUT[s - 2]
        k = np.flatnonzero(sel == s)
        if len(k):
            value, mask = words[head[k]], U((1 << bits) - 1)
            limit = (block_of[k] + 1) * block
            for j in range(c):
                ok = start[k] + j < limit
                out[(start[k] + j)[ok]] = ((value >> U(j * bits)) & mask)[ok]
    k = np.flatnonzero(sel == 0)
    out[start[k]] = words[head[k] + 1]
    return out[:n]


def write_segment(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    return b"".join((MAGIC, struct.pack("<IIIQQ", len(lengths), len(offsets) - 1, BLOCK, len(ids), len(words)), lengths.astype("<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def read_segment(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of each document, all ids)."""
    if blob[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    docs, blocks, block, n, n_words = struct.unpack_from("<IIIQQ", blob, 4)
    at = 4 + struct.calcsize("<IIIQQ")
    lengths = np.frombuffer(blob, "<u4", docs, at)
    at += 4 * docs
    offsets = np.frombuffer(blob, "<u4", blocks + 1, at)
    at += 4 * (blocks + 1)
    return lengths, unpack(np.frombuffer(blob, "<u8", n_words, at), offsets, n, block)


# -------------------------------------------------------------- tokenising
class Encoder:
    """Texts to ids with the ``tokenizers`` library.

    The byte-level pre-tokeniser always cuts before a single space between
    non-space characters, and between a Latin letter and following ASCII
    punctuation, so such pieces can be encoded apart; each different piece is
    encoded by the library once and kept in a bounded table keyed by two 64-bit
    hashes.  Texts with an added token or with white space the cut rule does not
    cover keep longer pieces, never other ids.
    """

    KEEP = 1_000_000
    SLOTS = 20
    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.opens = np.zeros(self.tok.get_vocab_size(), bool)  # tokens that begin with a space
        for token, i in self.tok.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")
        self.clear()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One encoder per Python worker and file: its table serves all tasks of the worker."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def clear(self) -> None:
        self.key = np.zeros(0, U)  # sorted
        self.check = np.zeros(0, U)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.slot_key = np.zeros(1 << self.SLOTS, U)  # a direct-mapped front of the sorted table
        self.slot_row = np.full(1 << self.SLOTS, -1, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: Words, new: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        """Encode the pieces numbered ``new`` and add them to the table."""
        texts = [words.word(i).decode("utf-8") for i in new]
        spaced = np.array([t[0] == " " and not _ANY_SPACE.search(t, 1) for t in texts], bool)
        got: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        one = np.flatnonzero(spaced)
        for lo in range(0, len(one), 2000):  # pieces that begin with a space can share a call
            part = one[lo : lo + 2000]
            ids = np.array(self.tok.encode("".join(texts[i] for i in part), add_special_tokens=False).ids, np.uint32)
            cut = np.flatnonzero(self.opens[ids])
            if len(cut) == len(part):
                for i, x in zip(part, np.split(ids, cut[1:])):
                    got[i] = x
        for i, x in enumerate(got):
            if x is None:
                got[i] = self.whole(texts[i])
        lens = np.array([len(x) for x in got], np.int32)
        flat = np.concatenate(got) if got else np.zeros(0, np.uint32)
        at = len(self.ids) + np.cumsum(lens) - lens
        self.ids = np.concatenate([self.ids, flat])
        order = np.argsort(key)
        key, check, at, lens = key[order], check[order], at[order], lens[order]
        where = np.searchsorted(self.key, key)
        self.key, self.check = np.insert(self.key, where, key), np.insert(self.check, where, check)
        self.at, self.len = np.insert(self.at, where, at), np.insert(self.len, where, lens)
        slot = (self.key >> U(64 - self.SLOTS)).astype(np.int64)
        self.slot_key[slot], self.slot_row[slot] = self.key, np.arange(len(self.key), dtype=np.int32)

    def _rows(self, h: np.ndarray) -> np.ndarray:
        """Table rows of hashes; -1: unknown."""
        slot = (h >> U(64 - self.SLOTS)).astype(np.int64)
        row = self.slot_row[slot]
        odd = np.flatnonzero((self.slot_key[slot] != h) | (row < 0))
        if len(odd):
            where = np.searchsorted(self.key, h[odd])
            where[where == len(self.key)] = 0
            row[odd] = np.where(self.key[where] == h[odd], where, -1) if len(self.key) else -1
        return row

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each document, all ids) of consecutive documents."""
        p = Pieces(data, offs)
        if not len(p):
            return np.zeros(p.n_docs, np.int64), np.zeros(0, np.uint32)
        h, g = p.hashes(0), p.hashes(1)
        row = self._rows(h)
        new = np.flatnonzero(row < 0)
        if len(new):
            if len(self.key) + len(new) > self.KEEP:
                self.clear()
                new = np.arange(len(h))
            key, first = np.unique(h[new], return_index=True)
            self._learn(p, new[first], key, g[new[first]])
            row = self._rows(h)
        if (self.check[row] != g).any():  # two pieces with one hash: beyond belief, but never wrong
            return self._plain(data, offs)
        at, lens = self.at[row], self.len[row].astype(np.int64)
        total = int(lens.sum())
        begin = np.cumsum(lens) - lens
        ids = self.ids[np.repeat(at - begin, lens) + np.arange(total)]
        per_doc = np.bincount(p.doc, weights=lens, minlength=p.n_docs).astype(np.int64)
        return per_doc, ids

    def _plain(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = [self.whole(data[a:b].tobytes().decode("utf-8")) for a, b in zip(offs[:-1], offs[1:])]
        return np.array([len(x) for x in got], np.int64), np.concatenate([*got, np.zeros(0, np.uint32)]).astype(np.uint32)

    def texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; documents that contain an added token go through the library whole."""
        raw = data.tobytes()
        hits = sorted({int(np.searchsorted(offs, m.start(), "right")) - 1 for a in self.added for m in re.finditer(re.escape(a.encode()), raw)})
        if not hits:
            return self.encode(data, offs)
        parts, lo = [], 0
        for d in [*hits, len(offs) - 1]:
            if lo < d:
                parts.append(self.encode(data[offs[lo] : offs[d]], offs[lo : d + 1] - offs[lo]))
            if d < len(offs) - 1:
                parts.append(self._plain(data[offs[d] : offs[d + 1]], offs[d : d + 2] - offs[d]))
            lo = d + 1
        return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])


#: Every character with the Unicode property White_Space (fixed values).
_ANY_SPACE = re.compile("[\t-\r \x85\xa0  -     　]")


class Pieces(Words):
    """Cuts texts where the pre-tokeniser surely cuts: before an ASCII white space that
    follows an ASCII letter, digit or punctuation or a Latin letter, and between an ASCII or
    Latin letter and an ASCII punctuation character."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n_docs = data, offs, len(offs) - 1
        n = len(data)
        kind = _KIND[data]
        cut = np.zeros(n + 1, bool)
        if n > 1:
            prev, here = kind[:-1], kind[1:]
            letter = prev == 1
            # The second byte of a two-byte Latin letter (U+00C0..U+024F without U+00D7 and U+00F7).
            lead = np.zeros(n, np.uint8)
            lead[1:] = data[:-1]
            latin = (lead >= 0xC4) & (lead <= 0xC8) & (data >= 0x80) | (lead == 0xC3) & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
            letter |= latin[:-1]
            cut[1:n] = (here == 3) & (letter | (prev == 2) | (prev == 4)) | (here == 2) & letter
        cut[offs] = True
        edges = np.flatnonzero(cut)
        self.starts, self.ends = edges[:-1], edges[1:]
        self.doc = np.searchsorted(offs, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)


#: 1 ASCII letter, 2 ASCII punctuation, 3 ASCII white space, 4 digit, 0 the rest.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = 4
_KIND[LOWER != np.arange(256)] = 1
_KIND[0x61:0x7B] = 1
_KIND[SPACE] = 3
assert NOT_SPACE[0x41]


# ------------------------------------------------------------------- Spark
SEGMENTS = "shard long, segment long, first_id long, doc_ids array<long>, n_ids long, payload binary"


def _segments(path: str, end_id: int, shard: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of one sorted partition, numbered within it."""
    enc = Encoder.of(path)
    docs: list[int | None] = []
    parts: list[np.ndarray] = []
    lens: list[np.ndarray] = []
    have, segment, begun = 0, 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal docs, parts, lens, have, segment, begun
        out = pa.record_batch({
            "shard": pa.array([shard], pa.int64()), "segment": pa.array([segment], pa.int64()), "first_id": pa.array([begun], pa.int64()),
            "doc_ids": pa.array([docs], pa.list_(pa.int64())), "n_ids": pa.array([have], pa.int64()),
            "payload": pa.array([write_segment(np.concatenate(lens), np.concatenate(parts))], pa.binary()),
        })
        begun, segment = begun + have, segment + 1
        docs, parts, lens, have = [], [], [], 0
        return out

    for batch in batches:
        data, offs = text_bytes(batch.column("text"))
        ids_of = batch.column("doc_id").to_pylist()
        for lo, hi in pieces(offs, 1 << 20):
            per, ids = enc.texts(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
            ends = np.cumsum(per)
            ids = np.insert(ids, ends, end_id)
            docs += ids_of[lo:hi]
            parts.append(ids)
            lens.append(per + 1)
            have += len(ids)
            if have >= SEGMENT_IDS:
                yield flush()
    if docs:
        yield flush()


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the files; returns (segments, manifest).

    The only shuffle is the range partitioning of the documents by id.  The manifest
    has a row per shard (output task): its first id number in the whole corpus.
    """
    from pyspark import TaskContext

    scratch = scratch or Scratch(spark, "simple8b")
    n = partitions or shuffle_partitions(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _segments(tokenizer_path, end_id, TaskContext.get().partitionId(), batches)

    ordered = pick(docs, doc_id=doc_id, text=text).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.coalesce("text", F.lit("")))
    segments = scratch.save(ordered.mapInArrow(write, SEGMENTS), "segments")
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))  # one row per output task
    manifest = scratch.save(shards.select("shard", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), "n_ids"), "manifest")
    return segments, manifest


DECODED = "shard long, doc_id long, at long, n_tokens long, ids_crc32 long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard, first = batch.column("shard")[row].as_py(), batch.column("first_id")[row].as_py()
            lens, ids = read_segment(batch.column("payload")[row].as_py())
            lens = lens.astype(np.int64)
            ends = np.cumsum(lens)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lens.tolist())]
            yield pa.record_batch({
                "shard": pa.array(np.full(len(lens), shard), pa.int64()), "doc_id": pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                "at": pa.array(first + ends - lens, pa.int64()), "n_tokens": pa.array(lens, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            })


def document_digests(segments: DataFrame, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    found = segments.select("shard", "first_id", "doc_ids", "payload").mapInArrow(_digests, DECODED)
    where = manifest.select(F.col("shard").alias("of"), "start")
    return found.join(where, same(found["shard"], where["of"])).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def decode_documents(segments: DataFrame) -> DataFrame:
    """doc_id and the ids themselves, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lens, ids = read_segment(batch.column("payload")[row].as_py())
                offs = np.concatenate([[0], np.cumsum(lens.astype(np.int64))])
                yield pa.record_batch({"doc_id": pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.astype(np.int64)))})

    return segments.select("doc_ids", "payload").mapInArrow(run, "doc_id long, ids array<long>")
