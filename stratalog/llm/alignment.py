"""Alignment of two tokenizers' vocabularies by inverted pair bitmaps.

Both tokenizers cut the same bytes, so the ends of their tokens cut a text into stretches; each stretch
lies in one token of either side, and the stretches are the links. Documents are numbered within
blocks. Per block and pair of ids there is one posting: a compressed bitmap of the documents that hold
the pair, and bit planes with how often they do. A pair's document count is the popcount of its bitmaps
OR-ed together, and as blocks share no document, the sum of their popcounts; the planes give the number
of links in the same way. The postings then carry the counts back to the documents of their block.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalog.llm.common import kept, share

VOCABULARIES = "/opt/tokenizers"
#: fixed value: how a byte-level tokenizer splits a text before its merges
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class AlignConfig:
    """Paths of a byte-level BPE (JSON) and a sentence-piece model; the driver reads them. A block ends
    with ``block_entries`` different (document, pair) entries or ``block_docs`` documents."""

    byte_level: str = os.path.join(VOCABULARIES, "byte_bpe_50k.json")
    pieces: str = os.path.join(VOCABULARIES, "piece_bpe_32k.model")
    block_entries: int = 2_000_000
    block_docs: int = 65_536
    chunk_bytes: int = 2_000_000


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_level(raw: bytes) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """Encoder of a byte-level BPE file, and the bytes of each id."""
    import tiktoken

    model = json.loads(raw)["model"]
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
    merged = [("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    numbers = [model["vocab"][m] for m in merged]
    if numbers != sorted(numbers):
        raise ValueError("ids of a byte-level vocabulary must follow the order of its merges")
    encoding = tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return (lambda text: np.array(encoding.encode_ordinary(text), dtype=np.int64)), table


def pieces(raw: bytes) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """Encoder of a sentence-piece model, and the bytes of each id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=raw)

    def bytes_of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return (lambda text: np.array(model.encode(text, num_threads=1), dtype=np.int64)), [bytes_of(i) for i in range(len(model))]


class Aligner:
    """Both tokenizers, made once per task."""

    def __init__(self, first: bytes, second: bytes):
        self.encode_a, self.bytes_a = byte_level(first)
        self.encode_b, self.bytes_b = pieces(second)
        self.sizes = [np.array([len(t) for t in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b)]
        # an id with what follows it in the groups of a document
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.written = [b"%d%s" % (i, end) for n, ends in ((na, (b",", b"|")), (nb, (b",", b";"))) for end in ends for i in range(n)]
        self.start = [0, na, 2 * na, 2 * na + nb]  # where each of the four lists begins

    def tokens(self, raw: bytes | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; none for an empty text, or one that a side doesn't give back whole."""
        if not raw:
            return None
        text = raw.decode("utf-8", "replace")
        a, b = self.encode_a(" " + text), self.encode_b(text)
        whole = b" " + raw
        for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(table.__getitem__, ids.tolist())) != whole:
                return None
        return a, b

    def aligned(self, texts: list[bytes | None]) -> tuple[list[tuple[int, int, int, int, str]], np.ndarray, np.ndarray]:
        """``(n_a, n_b, n_groups, n_links, groups_sha256)`` per text, and all links as text number and
        pair number (``a`` times the size of B's vocabulary plus ``b``)."""
        both = [self.tokens(t) for t in texts]
        out: list[tuple[int, int, int, int, str]] = [(0, 0, 0, 0, "")] * len(texts)
        full = [i for i, x in enumerate(both) if x is not None]
        if not full:
            return out, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        a, b = (np.concatenate([both[i][side] for i in full]) for side in (0, 1))
        n_a, n_b = (np.array([len(both[i][side]) for i in full]) for side in (0, 1))
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.union1d(end_a, end_b)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        text_ends = end_a[np.cumsum(n_a) - 1]
        text_of = np.searchsorted(text_ends, ends)
        in_a, in_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs = a[in_a] * len(self.bytes_b) + b[in_b]

        # place of each token in the sequence of groups: A's tokens of a group, then B's
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        up_to_a = np.cumsum(np.bincount(group_a, minlength=len(common)))
        up_to_b = np.cumsum(np.bincount(group_b, minlength=len(common)))
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        last_a, last_b = end_a == common[group_a], end_b == common[group_b]
        before_b = np.concatenate([[0], up_to_b])[group_a]
        codes[np.arange(len(a)) + before_b] = a + np.where(last_a, self.start[1], self.start[0])
        codes[np.arange(len(b)) + up_to_a[group_b]] = b + np.where(last_b, self.start[3], self.start[2])
        n_groups = np.bincount(np.searchsorted(text_ends, common), minlength=len(full))
        n_links = np.bincount(text_of, minlength=len(full))
        cut = np.cumsum(n_a + n_b)
        spelled = codes.tolist()
        for k, i in enumerate(full):
            line = b"".join(map(self.written.__getitem__, spelled[cut[k] - n_a[k] - n_b[k] : cut[k]]))[:-1]
            out[i] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), hashlib.sha256(line).hexdigest())
        return out, np.array(full)[text_of], pairs


_BITS = np.uint8(1) << np.arange(8, dtype=np.uint8)


@dataclass(frozen=True)
class Postings:
    """Postings of a block, one per pair: ``docs`` is the bitmap, as a list of 16-bit numbers or, where
    that is shorter, as bits (``dense``). Plane k of ``planes`` holds bit k of how often beyond once the
    documents hold the pair, in the order of the bitmap; no plane if all hold it once."""

    pair: np.ndarray
    n_docs: np.ndarray
    n_links: np.ndarray
    dense: np.ndarray
    docs: tuple[np.ndarray, np.ndarray]
    planes: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> Postings:
        """From entries sorted by pair and document."""
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        n = np.diff(np.append(starts, len(pair)))
        own = np.repeat(np.arange(len(starts)), n)
        rank = np.arange(len(pair)) - starts[own]
        bits = (int(doc.max(initial=0)) >> 3) + 1
        dense = 2 * n > bits
        size = np.where(dense, bits, 2 * n)
        at = np.concatenate([[0], np.cumsum(size)])
        docs = np.zeros(at[-1], dtype=np.uint8)
        sparse = ~dense[own]
        place = at[own[sparse]] + 2 * rank[sparse]
        docs[place], docs[place + 1] = doc[sparse] & 255, doc[sparse] >> 8
        np.bitwise_or.at(docs, at[own[~sparse]] + (doc[~sparse] >> 3), _BITS[doc[~sparse] & 7])

        more = times - 1
        most = np.maximum.reduceat(more, starts) if len(starts) else more
        count = np.ceil(np.log2(most + 1)).astype(np.int64)
        width = (n + 7) // 8
        to = np.concatenate([[0], np.cumsum(count * width)])
        planes = np.zeros(to[-1], dtype=np.uint8)
        for k in range(int(count.max(initial=0))):
            has = np.flatnonzero((more >> k) & 1)
            np.bitwise_or.at(planes, to[own[has]] + k * width[own[has]] + (rank[has] >> 3), _BITS[rank[has] & 7])
        links = np.add.reduceat(times, starts) if len(starts) else times
        return Postings(pair[starts], n, links, dense, (at, docs), (to, planes))

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(posting, doc, times)`` of all entries."""
        own = np.repeat(np.arange(len(self.n_docs)), self.n_docs)
        rank = np.arange(len(own)) - np.repeat(np.cumsum(self.n_docs) - self.n_docs, self.n_docs)
        at, data = self.docs
        doc = np.zeros(len(own), dtype=np.int64)
        sparse = ~self.dense[own]
        place = at[:-1][own[sparse]] + 2 * rank[sparse]
        doc[sparse] = data[place].astype(np.int64) | data[place + 1].astype(np.int64) << 8
        bits = [np.flatnonzero(np.unpackbits(data[at[i] : at[i + 1]], bitorder="little")) for i in np.flatnonzero(self.dense)]
        if bits:
            doc[~sparse] = np.concatenate(bits)
        to, planes = self.planes
        width = (self.n_docs + 7) // 8
        count = np.diff(to) // width
        times = np.ones(len(own), dtype=np.int64)
        for k in range(int(count.max(initial=0))):
            has = np.flatnonzero(count[own] > k)
            byte = planes[to[:-1][own[has]] + k * width[own[has]] + (rank[has] >> 3)]
            times[has] += (byte >> (rank[has] & 7).astype(np.uint8) & 1).astype(np.int64) << k
        return own, doc, times


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())]
    ).cast(pa.binary())


def _bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    one = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    one = one.cast(pa.large_binary())
    offsets = np.frombuffer(one.buffers()[1], dtype=np.int64)[one.offset : one.offset + len(one) + 1]
    data = np.frombuffer(one.buffers()[2], dtype=np.uint8) if one.buffers()[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


_OF_DOC = (("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()))
_OF_PAIR = (("a", pa.int32()), ("b", pa.int32()), ("n_docs", pa.int32()), ("links", pa.int64()), ("dense", pa.bool_()), ("docs", pa.binary()), ("planes", pa.binary()))
_KINDS = {pa.int64(): "long", pa.int32(): "integer", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}


def _pad(fields: tuple, n: int) -> dict[str, pa.Array]:
    return {name: pa.nulls(n, kind) for name, kind in fields}


def aligned_blocks(docs: DataFrame, cfg: AlignConfig = AlignConfig()) -> DataFrame:
    """One table with a row per document (``row``: all columns of ``docs``; ``place``: its number in
    its block) and a row per posting (``a, b, n_docs, links, dense, docs, planes``), both with ``block``.
    """
    with open(cfg.byte_level, "rb") as one, open(cfg.pieces, "rb") as two:
        shared = share(docs.sparkSession, (one.read(), two.read()))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(*shared())
        vocabulary = len(aligner.bytes_b)
        block = TaskContext.get().partitionId() << 32
        number, size, held = 0, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            key, times = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            p = Postings.of(key >> 16, key & 0xFFFF, times)
            columns = {
                "a": pa.array((p.pair // vocabulary).astype(np.int32)), "b": pa.array((p.pair % vocabulary).astype(np.int32)),
                "n_docs": pa.array(p.n_docs.astype(np.int32)), "links": pa.array(p.n_links), "dense": pa.array(p.dense),
                "docs": _binary(*p.docs), "planes": _binary(*p.planes),
            }
            n = len(p.pair)
            rows = {"block": pa.array(np.full(n, block)), "place": pa.nulls(n, pa.int32()), "row": pa.nulls(n, row_type)}
            table = pa.table(rows | _pad(_OF_DOC, n) | columns)
            yield from table.to_batches(max_chunksize=65_536)

        for batch in batches:
            texts, row_type = batch.column("text"), batch.column("row").type
            # pieces of a batch by bytes, so that neither links nor strings of many texts pile up
            width = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
            cuts = np.flatnonzero(np.diff(width // cfg.chunk_bytes, prepend=0)).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
                while start < end:
                    stop = min(end, start + cfg.block_docs - number)
                    found, of, pairs = aligner.aligned(texts.slice(start, stop - start).to_pylist())
                    key, times = np.unique(pairs << 16 | (of + number), return_counts=True)
                    held.append((key, times))
                    n = stop - start
                    columns = {
                        name: pa.array(values, kind)
                        for (name, kind), values in zip(_OF_DOC, zip(*found, strict=True), strict=True)
                    }
                    rows = {
                        "block": pa.array(np.full(n, block)),
                        "place": pa.array(np.arange(number, number + n, dtype=np.int32)),
                        "row": batch.column("row").slice(start, n),
                    }
                    yield from pa.table(rows | columns | _pad(_OF_PAIR, n)).to_batches()
                    number, size, start = number + n, size + len(key), stop
                    if size >= cfg.block_entries or number >= cfg.block_docs:
                        yield from flush()
                        block, number, size, held = block + 1, 0, 0, []
        if held:
            yield from flush()

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(0).alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col("text").cast("binary").alias("text"))
    kinds = StructType().add("block", "long").add("place", "integer").add("row", rows.schema["row"].dataType)
    for name, kind in (*_OF_DOC, *_OF_PAIR):
        kinds = kinds.add(name, _KINDS[kind])
    return kept(rows.mapInArrow(make, kinds), "alignment")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(a, b, count, links, best)``: documents and links of each pair over all blocks; ``best`` is 1
    where no pair of the same A id has a larger document count."""
    # not written out, a file per partition costs more than the sums; where both ids are said to be there, both uses share one shuffle
    found = blocks.where("a is not null and b is not null").groupBy("a", "b").agg(
        F.sum("n_docs").alias("count"), F.sum("links").alias("links")
    )
    # a row per id of A's vocabulary at most
    most = F.broadcast(found.groupBy("a").agg(F.max("count").alias("most")))
    return found.join(most, "a").select("a", "b", "count", "links", (F.col("count") == F.col("most")).cast("int").alias("best"))


def document_scores(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """``(block, place, n_best, count_sum)`` of the documents that hold a pair: each posting, with its
    pair's count, gives it to the documents of its bitmap as often as its planes say."""

    def add(postings: pa.Table) -> pa.Table:
        column = {name: postings.column(name) for name in postings.column_names}
        number = {n: column[n].to_numpy() for n in ("n_docs", "dense", "count", "best")}
        p = Postings(
            number["n_docs"], number["n_docs"].astype(np.int64), number["n_docs"], number["dense"].astype(bool),
            _bytes_of(column["docs"]), _bytes_of(column["planes"]),
        )
        own, doc, times = p.entries()
        sums, best = np.zeros(65_536, dtype=np.int64), np.zeros(65_536, dtype=np.int64)
        np.add.at(sums, doc, times * number["count"].astype(np.int64)[own])
        np.add.at(best, doc, times * number["best"].astype(np.int64)[own])
        at = np.unique(doc)
        return pa.table(
            {
                "block": pa.array(np.full(len(at), column["block"][0].as_py())),
                "place": pa.array(at.astype(np.int32)),
                "n_best": pa.array(best[at]), "count_sum": pa.array(sums[at]),
            }
        )

    postings = blocks.where("a is not null").select("block", "a", "b", "n_docs", "dense", "docs", "planes")
    scored = postings.join(counts.select("a", "b", "count", "best"), ["a", "b"])
    scored = scored.select("block", "n_docs", "dense", "docs", "planes", "count", "best")
    return scored.groupBy("block").applyInArrow(add, "block long, place int, n_best long, count_sum long")


def alignments(docs: DataFrame, cfg: AlignConfig = AlignConfig()) -> DataFrame:
    """All columns but ``text`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    (replacing columns of those names), a row per row of ``docs``, repeated rows each their own.

    Null and empty texts, texts that are no UTF-8, and texts that either side doesn't give back byte by
    byte have no tokens: zeros and an empty digest. A text is worked on whole, whatever its length. An
    empty table gives no rows.
    """
    blocks = aligned_blocks(docs, cfg)
    found = document_scores(blocks, pair_counts(blocks))
    rows = blocks.where("place is not null").select("block", "place", "row", *[n for n, _ in _OF_DOC])
    added = [n for n, _ in _OF_DOC] + ["n_best", "count_sum"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c != "text" and c not in added]
    zero = F.lit(0).cast("bigint")
    return rows.join(found, ["block", "place"], "left").select(
        *own, "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
