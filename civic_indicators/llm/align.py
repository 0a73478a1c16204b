"""Operator 12: alignment of two tokenizers over a corpus, with counts by external merging.

Each text is encoded by a byte-level BPE (A, over space + text) and a piece BPE with byte
fallback (B, over the text; it adds the space). Byte offsets where tokens of both end cut the
tokens into groups; an A and a B token are linked if their byte ranges overlap. The count of a
pair of ids is the number of documents (rows) that hold it linked, and a document's report
needs the counts of all its links and, for each A id, the highest count of any pair with it.

The counting is external, so its memory does not grow with the corpus:

1. Runs. A task gathers the (pair, document) records of its documents; a full buffer becomes a
   run. The run keeps its records by document, and its pairs, each once with the number of its
   documents, in the order (radix of the A id, A id, B id). Both are written as zstd
   compressed rows: the records stay where they are, the pairs are cut into chunks by radix.
2. Merge. The chunks of a radix meet in one task, in the order of their first pair. A heap of
   open chunks yields one A id after the other, side by side from all runs; the sum of a
   pair's numbers is its count, and with an A id's last pair its highest count is known.
   Each chunk's counts stream back as soon as it is done. A frequent A id arrives as one
   record per run and pair, not per document.
3. Report. A run's records meet its counts, in the order of its pairs, and are summed by document.

Runs and chunks are Spark rows in the shared folder and in shuffle files, so a lost executor
costs a task, not the job.

Results: a null or empty text, and one whose joined token bytes differ from space + text (a
piece stands for another character, an unknown piece, bytes that are no UTF-8), has zeros and
an empty ``groups_sha256``. Each row is a document, also where ids or whole rows repeat; a null id
is carried along. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import q, shared_dir

# FIXED VALUE: how the byte-level tokenizer splits text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ROWS = "kind int, run bigint, radix int, seq int, first bigint, payload binary"
REPORT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")


@dataclass(frozen=True)
class Alignment:
    """Parameters: the vocabulary files, records a run, pairs a chunk, least number of radix partitions."""

    byte_bpe: str = "/opt/tokenizers/byte_bpe_50k.json"
    piece_bpe: str = "/opt/tokenizers/piece_bpe_32k.model"
    run_records: int = 2_000_000
    chunk_pairs: int = 20_000
    radix: int = 256


# ---------------------------------------------------------------- tokenizers

def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """A byte-level BPE from its JSON file (bytes); its special tokens are plain text."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        model, letters = spec["model"], _byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        first = len(ranks) - len(pairs)
        pre = spec.get("pre_tokenizer") or {}
        ranked = all(model["vocab"][a + b] == first + i for i, (a, b) in enumerate(pairs))
        if ranked and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer"):
            import tiktoken  # the ids are the order of the merges: the same result, several times as fast
            self.encode = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_str(source.decode())
            t.encode_special_tokens = True
            self.encode = lambda s: t.encode(s, add_special_tokens=False).ids


class PieceBpe:
    """A sentencepiece model (bytes)."""

    def __init__(self, source: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.encode = lambda s: sp.encode(s, num_threads=1)
        # An unknown piece stands for no known bytes: one that no text holds makes the joined bytes differ.
        self.bytes = [b"\xff" if sp.is_unknown(i) or sp.is_control(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                      else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]


class Aligner:
    """Aligns the two token sequences of a text."""

    def __init__(self, a: ByteBpe, b: PieceBpe):
        self.a, self.b = a, b
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        n, m = len(a.bytes), len(b.bytes)
        self.n_a, self.n_b = n, m
        self.written = [b"%d%c" % (i, c) for i in range(n) for c in b",|"] + [b"%d%c" % (i, c) for i in range(m) for c in b",;"]

    def __call__(self, raw: bytes | None):
        """(A ids, B ids, A id of each link, B id of each link, number of groups, digest), or None if the text has no tokens."""
        if not raw:
            return None
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
        want = b" " + raw
        ids_a, ids_b = self.a.encode(" " + text), self.b.encode(text)
        bytes_a, bytes_b = self.a.bytes, self.b.bytes
        if b"".join([bytes_a[i] for i in ids_a]) != want or b"".join([bytes_b[i] for i in ids_b]) != want:
            return None
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.zeros(len(want) + 1, np.uint8)
        ends[end_a] = 1
        ends[end_b] |= 2
        # Between one end and the next lies the overlap of one pair: a link.
        cuts = ends[np.flatnonzero(ends)]
        in_a, in_b = cuts & 1, cuts >> 1
        link_a, link_b = a[np.cumsum(in_a) - in_a], b[np.cumsum(in_b) - in_b]
        # The groups as text: each group's A ids, then its B ids.
        last_a, last_b = ends[end_a] == 3, ends[end_b] == 3
        before_a, before_b = np.r_[0, np.flatnonzero(last_a) + 1], np.r_[0, np.flatnonzero(last_b) + 1]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + before_a[group_b + 1]] = 2 * self.n_a + 2 * b + last_b
        written = self.written
        digest = hashlib.sha256(b"".join([written[i] for i in order.tolist()])[:-1]).digest()
        return a, b, link_a, link_b, int(last_a.sum()), digest


# -------------------------------------------------------------------- packing

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame; the bytes of numbers lie plane by plane, which compresses small numbers well."""
    out = [struct.pack("<B", len(arrays))]
    for x in arrays:
        out.append(struct.pack("<2sQ", x.dtype.str[1:].encode(), len(x)))
        out.append(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, out = raw[0], 1, []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sQ", raw, at)
        dtype = np.dtype(kind.decode())
        at += 10
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(size))
        at += size * dtype.itemsize
    return out


def _steps(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences within the stretches that begin at ``starts``; there the value itself."""
    d = np.diff(x, prepend=0)
    d[starts] = x[starts]
    return d


def _sums(d: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums within stretches of the given lengths: undoes ``_steps``."""
    total = np.cumsum(d)
    starts = np.cumsum(lengths) - lengths
    full = lengths > 0
    return total - np.repeat(np.r_[0, total][starts[full]], lengths[full])


# ----------------------------------------------------------------------- runs

def _radix(a: np.ndarray, radix: int) -> np.ndarray:
    """A number below ``radix`` (a power of two) for each A id, neighbours apart."""
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (radix - 1)


class Run:
    """The (pair, document) records of some documents."""

    def __init__(self, n_b: int, radix: int):
        self.n_b, self.radix, self.records = n_b, radix, 0
        self.ids, self.rows, self.keys, self.times = [], [], [], []

    def add(self, doc_id: int | None, found) -> None:
        self.ids.append(doc_id)
        if found is None:
            self.rows.append((0, 0, 0, 0, 0, b""))
            return
        a, b, link_a, link_b, groups, digest = found
        keys, times = np.unique((_radix(link_a, self.radix) << 40) | (link_a * self.n_b + link_b), return_counts=True)
        self.keys.append(keys)
        self.times.append(times.astype(np.uint32))
        self.records += len(keys)
        self.rows.append((len(a), len(b), groups, len(link_a), len(keys), digest))

    def parts(self, chunk: int):
        """(kind, radix, seq, first, payload): the records, then the chunks of pairs."""
        none = np.zeros(0, np.int64)
        keys = np.concatenate(self.keys) if self.keys else none
        pairs, place, docs = np.unique(keys, return_inverse=True, return_counts=True)
        numbers = np.array([r[:5] for r in self.rows], np.uint32).reshape(-1, 5)
        size = numbers[:, 4].astype(np.int64)
        starts = (np.cumsum(size) - size)[size > 0]
        known = np.array([i is not None for i in self.ids], np.uint8)
        yield 0, 0, 0, 0, pack(np.array([i or 0 for i in self.ids], np.int64), known, *[np.ascontiguousarray(c) for c in numbers.T],
                               np.frombuffer(b"".join(r[5] for r in self.rows), np.uint8),
                               _steps(place.astype(np.int64), starts).astype(np.uint32), np.concatenate(self.times) if self.times else none.astype(np.uint32))
        radix, codes = pairs >> 40, pairs & ((1 << 40) - 1)
        cut = np.flatnonzero(np.diff(radix, prepend=-1))
        for lo, hi in zip(cut, np.r_[cut[1:], len(pairs)]):
            for seq, i in enumerate(range(lo, hi, chunk)):
                c = codes[i:min(i + chunk, hi)]
                yield 1, int(radix[lo]), seq, int(c[0]), pack(np.diff(c, prepend=c[0]).astype(np.uint64), docs[i:i + len(c)].astype(np.uint32))


def runs(docs: DataFrame, p: Alignment, text: str, doc_id: str) -> DataFrame:
    """The runs of ``docs``, written in the shared folder: kind 0 records, kind 1 chunks of pairs."""
    spark = docs.sparkSession
    with open(p.byte_bpe, "rb") as f, open(p.piece_bpe, "rb") as g:  # about two megabytes, whatever the input
        shared = spark.sparkContext.broadcast((f.read(), g.read()))
    radix = 1 << (max(p.radix, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length()

    def gather(batches):
        source_a, source_b = shared.value
        align = Aligner(ByteBpe(source_a), PieceBpe(source_b))
        part, n = TaskContext.get().partitionId(), 0
        run = Run(align.n_b, radix)

        def rows(run: Run):
            at = (part << 32) | n
            for kind, r, seq, first, payload in run.parts(p.chunk_pairs):
                yield pa.record_batch([pa.array([v], t) for v, t in ((kind, pa.int32()), (at, pa.int64()), (r, pa.int32()), (seq, pa.int32()),
                                                                     (first, pa.int64()), (payload, pa.binary()))],
                                      ["kind", "run", "radix", "seq", "first", "payload"])

        def together(parts):
            held, size = [], 0
            for b in parts:
                held.append(b)
                size += b.nbytes
                if size > 1 << 22:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                run.add(i, align(t.as_py()))
                if run.records >= p.run_records or len(run.ids) >= p.run_records:
                    yield from together(rows(run))
                    run, n = Run(align.n_b, radix), n + 1
        if run.ids:
            yield from together(rows(run))

    path = f"{shared_dir(spark)}/align-{uuid.uuid4().hex}"
    docs.select(q(doc_id).cast("bigint"), q(text).cast("binary")).mapInArrow(gather, ROWS).write.partitionBy("kind").parquet(path)
    return spark.read.schema(ROWS).parquet(path)


# ---------------------------------------------------------------------- merge

class _Chunk:
    """A chunk of pairs with its A ids; its counts fill up while it is open."""

    def __init__(self, run: int, radix: int, seq: int, first: int, payload: bytes, n_b: int):
        self.run, self.radix, self.seq = run, radix, seq
        steps, self.docs = unpack(payload)
        self.codes = np.cumsum(steps).astype(np.int64) + first
        a = self.codes // n_b
        self.starts = np.flatnonzero(np.diff(a, prepend=-1))
        self.ids = a[self.starts].tolist()
        self.ends = np.r_[self.starts[1:], len(a)].tolist()
        self.starts = self.starts.tolist()
        self.at = 0
        self.count, self.best = np.zeros(len(a), np.int64), np.zeros(len(a), np.uint8)


def merge(chunks, n_b: int):
    """The chunks of one radix, in the order of their first pair, each with its counts once it is done."""
    heap: list[tuple[int, int, _Chunk]] = []
    coming, n = next(chunks, None), 0
    while heap or coming is not None:
        while coming is not None and (not heap or coming.ids[0] <= heap[0][0]):
            heapq.heappush(heap, (coming.ids[0], n, coming))
            coming, n = next(chunks, None), n + 1
        side, same = heap[0][0], []
        while heap and heap[0][0] == side:
            same.append(heapq.heappop(heap))
        cuts = [(c, c.starts[c.at], c.ends[c.at]) for _, _, c in same]
        codes, place = np.unique(np.concatenate([c.codes[i:j] for c, i, j in cuts]), return_inverse=True)
        docs = np.zeros(len(codes), np.int64)
        np.add.at(docs, place, np.concatenate([c.docs[i:j] for c, i, j in cuts]))
        count = docs[place]
        best, at = count == docs.max(), 0
        for (c, i, j), (_, order, _) in zip(cuts, same):
            c.count[i:j], c.best[i:j] = count[at:at + j - i], best[at:at + j - i]
            at += j - i
            c.at += 1
            if c.at < len(c.ids):
                heapq.heappush(heap, (c.ids[c.at], order, c))
            else:
                yield c


def counted(found: DataFrame, n_b: int) -> DataFrame:
    """Each chunk with the counts of its pairs, and which of them are highest for their A id."""
    def run(batches):
        def chunks():
            for batch in batches:
                cols = [batch.column(c) for c in ("run", "radix", "seq", "first", "payload")]
                for i in range(len(batch)):
                    yield _Chunk(*[c[i].as_py() for c in cols], n_b)

        held = chunks()
        ahead = [next(held, None)]

        def of(radix: int):
            while ahead[0] is not None and ahead[0].radix == radix:
                c, ahead[0] = ahead[0], next(held, None)
                yield c

        while ahead[0] is not None:
            for c in merge(of(ahead[0].radix), n_b):
                yield pa.record_batch([pa.array([v], t) for v, t in ((2, pa.int32()), (c.run, pa.int64()), (c.radix, pa.int32()), (c.seq, pa.int32()),
                                                                     (0, pa.int64()), (pack(c.count.astype(np.uint64), c.best), pa.binary()))],
                                      ["kind", "run", "radix", "seq", "first", "payload"])

    chunks = found.where("kind = 1").repartition("radix").sortWithinPartitions("radix", "first", "run", "seq")
    return chunks.mapInArrow(run, ROWS)


# --------------------------------------------------------------------- report

def _report(records: bytes, counts: list[bytes]) -> pa.RecordBatch:
    ids, known, n_a, n_b, groups, links, size, digests, steps, times = unpack(records)
    size = size.astype(np.int64)
    place = _sums(steps.astype(np.int64), size)
    parts = [unpack(x) for x in counts]
    count = np.concatenate([x[0] for x in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
    best = np.concatenate([x[1] for x in parts]) if parts else np.zeros(0, np.uint8)
    times = times.astype(np.int64)
    total, n_best = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    full = np.flatnonzero(size)
    if len(full):
        starts = (np.cumsum(size) - size)[full]
        total[full] = np.add.reduceat(times * count[place], starts)
        n_best[full] = np.add.reduceat(times * best[place], starts)
    hexes, digests = [""] * len(ids), digests.tobytes()
    for k, i in enumerate(np.flatnonzero(n_a)):
        hexes[i] = digests[32 * k:32 * k + 32].hex()
    return pa.record_batch([pa.array(ids, mask=known == 0), *[pa.array(x.astype(np.int64)) for x in (n_a, n_b, groups, links, n_best, total)], pa.array(hexes, pa.string())],
                           ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def alignment(docs: DataFrame, p: Alignment = Alignment(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    found = runs(docs, p, text, doc_id)
    with open(p.piece_bpe, "rb") as f:
        n_b = len(PieceBpe(f.read()).bytes)
    both = found.where("kind = 0").unionByName(counted(found, n_b)).select("run", "kind", "radix", "seq", "payload")
    both = both.repartition("run").sortWithinPartitions("run", "kind", "radix", "seq")

    def report(batches):
        run, records, counts = None, None, []
        for batch in batches:
            for at, kind, payload in zip(batch.column("run").to_pylist(), batch.column("kind").to_pylist(), batch.column("payload")):
                if kind == 0:
                    if records is not None:
                        yield _report(records, counts)
                    run, records, counts = at, payload.as_py(), []
                else:
                    assert at == run
                    counts.append(payload.as_py())
        if records is not None:
            yield _report(records, counts)

    return both.mapInArrow(report, REPORT)
