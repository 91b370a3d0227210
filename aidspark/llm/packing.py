"""Packing by concatenate-and-cut.

The token stream of all documents is the concatenation of the scan partitions
in order. Pass one tokenises each document once, stores its ids and its place
within the partition; the totals of the partitions (one number each) are
prefix-summed into partition offsets. Pass two only adds the offset and cuts
the stream at every multiple of the window, so no document is moved and no
task sees more than a chunk of one document at a time.

Pieces carry the boundary records: which document, from which of its ids, where
in which sequence. Every sequence but the last is full.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed once each; an empty table gives no rows; very long documents travel as
chunks of ``CHUNK`` ids, cut where a chunk ends as well.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidspark.llm.common import documents, materialize

WINDOW = 4096
END_ID = 2
CHUNK = 1 << 16
TOKENIZER = "word_bpe_49k.json"

_CHUNKS = ("part int, ordinal long, doc_id long, doc_start long, part_start long, "
           "n long, doc_tokens long, ids binary")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: How the tokenizer splits a normalised text.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for ASCII in lower case.
PRETOKEN_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable letter: the byte itself
    where that is printable, else the next letter from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian uint32; an array costs a tenth of numpy's on so few."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class ChunkIds(dict):
    """white-space-free chunk of text -> its ids as little-endian uint32 bytes.

    The tokenizer drops white space and never joins text across it, so a
    document's ids are the ids of its chunks one after the other. A chunk of
    printable letters below U+0180, where normalising is lower-casing, is split
    by the tokenizer's own pattern and its parts are looked up or merged by its
    BPE model; any other chunk goes through the whole tokenizer. A chunk of ASCII
    letters is one part, and printable ASCII stands for itself in the model.

    When the memory is full, the chunks in it become the older half, from which
    those that are met again come back; so common ones are never worked out anew."""

    LIMIT = 400_000

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRETOKEN).findall
        self.split_ascii = re.compile(PRETOKEN_ASCII).findall
        self.letters = _byte_letters()
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # the short way holds for this kind of tokenizer only; others take the whole way
        probe = "It's 12 words, Caf\u00e9!"
        self.short = [i for w in probe.split() for i in np.frombuffer(self._short(w), "<u4").tolist()] == (
            self.tokenizer.encode(probe, add_special_tokens=False).ids)

    def _short(self, text: str) -> bytes:
        text, plain, known, out = text.lower(), text.isascii(), self.parts, []
        for part in (text,) if plain and text.isalpha() else (self.split_ascii if plain else self.split)(text):
            ids = known.get(part)
            if ids is None:
                if len(known) >= self.LIMIT:
                    known.clear()
                ids = known[part] = self._merged(part, plain)
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def _merged(self, part: str, plain: bool) -> bytes:
        mapped = part if plain else part.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.tokenizer.model.tokenize(mapped)])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            if self.short and text.isprintable() and "<|" not in text and (
                    text.isascii() or max(text) < "\u0180" and "\u0130" not in text):
                ids = self._short(text)
            else:
                ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids


_MEMO: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """The memory of this worker process, shared by its tasks."""
    if path not in _MEMO:
        _MEMO[path] = ChunkIds(path)
    return _MEMO[path]


def token_bytes(memo: ChunkIds, words: list[bytes]) -> bytes:
    return b"".join(map(memo.__getitem__, words))


def _tokenise(path: str, end_id: int):
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches):
        memo, part, ordinal, at = chunk_ids(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = token_bytes(memo, text.encode().split()) + end
                total = len(ids) // 4
                for start in range(0, total, CHUNK):
                    piece = ids[4 * start:4 * (start + CHUNK)]
                    n = len(piece) // 4
                    rows.append((part, ordinal, doc_id, start, at, n, total, piece))
                    at, ordinal, size = at + n, ordinal + 1, size + len(piece)
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
    return run


_ARROW = pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
                    ("doc_start", pa.int64()), ("part_start", pa.int64()), ("n", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def token_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pass one: the ids of every document, written once, with their place in
    the scan partition."""
    src = documents(docs, id_col, text_col)
    return materialize(src.mapInArrow(_tokenise(tokenizer or tokenizer_path(), end_id), _CHUNKS),
                       "tokens")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids`` (little-endian
    uint32), ``doc_tokens, sequence_id, offset, sequence_length`` (ids in the
    sequence) and ``padded_length`` (the window, or the length itself where it
    is a power of two)."""
    chunks = token_chunks(docs, id_col, text_col, tokenizer, end_id)
    totals = chunks.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per scan partition: prefix sums over the totals.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
                            F.sum("total").over(Window.partitionBy()).alias("all_ids"))
    at = F.col("base") + F.col("part_start")
    w = F.lit(window)
    # four numbers for each scan partition, of which the driver holds one task each anyway
    placed = (chunks.join(F.broadcast(offsets), "part").withColumn("at", at)
              .withColumn("sequence_id", F.explode(F.sequence(
                  F.floor(F.col("at") / w), F.floor((F.col("at") + F.col("n") - 1) / w)))))
    first = F.greatest(F.col("sequence_id") * w - F.col("at"), F.lit(0))
    end = F.least((F.col("sequence_id") + 1) * w - F.col("at"), F.col("n"))
    cut = placed.withColumns({"first": first, "length": end - first})
    length = F.least(w, F.col("all_ids") - F.col("sequence_id") * w)
    power = F.col("sequence_length").bitwiseAND(F.col("sequence_length") - 1) == 0
    return (cut.select(
        "doc_id", (F.col("doc_start") + F.col("first")).alias("start"), "length",
        F.substring("ids", (F.col("first") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
        "doc_tokens", "sequence_id",
        (F.col("at") + F.col("first") - F.col("sequence_id") * w).alias("offset"),
        length.cast("long").alias("sequence_length"))
        .withColumn("padded_length", F.when(power, F.col("sequence_length")).otherwise(F.lit(window).cast("long"))))
