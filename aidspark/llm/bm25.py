"""Benchmark decontamination: a BM25 index of test items, asked by every
training passage with block-max pruning.

Test items are cut into segments of at most ``SEGMENT`` words; the index holds a
BM25 impact for each term of each segment, as a share of what the segment needs
to be retrieved: ``min_score`` of the score of its own words. Training texts are
cut into passages of two segments' length that start at each segment's length,
so a copied segment lies whole in one passage. A passage is a query: by the
largest impact of its words anywhere, then by the largest in each block of
segments, whole passages and blocks that cannot reach the threshold are skipped
(the bounds of block-max WAND, taken for many passages at once); the rest are
scored exactly, and every segment above the threshold is retrieved.

A retrieved item is verified on the whole document: the last sentence of an item
is its answer, the rest its question, and the document must hold ``min_overlap``
of the distinct 5-word shingles of the item and ``min_part`` of those of the
question and of the answer.

The index is built by Spark and broadcast in blocks of ``ITEMS_PER_PASS`` items,
one pass over the texts for each; document frequencies are those of all items.
No row is moved, so no key can be hot.

Defined cases: null and empty texts hold nothing and items without words are
never found; a null id stays null; rows that repeat an item's id and text are
one item; repeated training rows are reported each; an item of one sentence is
its own question and answer; items of equal scores are all reported; very long
texts are asked whole, passage by passage; columns other than ids and texts are
not read; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, documents, keyed, materialize, ngram_hashes, packed, unpacked

SEGMENT = 64
ITEMS_PER_PASS = 2_000
SEGMENTS_PER_BLOCK = 8
MIN_SCORE = 0.5
MIN_OVERLAP, MIN_PART = 0.8, 0.5
SHINGLE = 5
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]+")
_ANSWER = re.compile(r"(?<=[.?!])\s+(?=\S[^.?!]*[.?!]*\s*$)")


class _Hash(WordHash):
    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; with one sentence both are the text."""
    parts = _ANSWER.split(text.strip())
    if len(parts) < 2 or not words(parts[-1]) or not words(" ".join(parts[:-1])):
        return text, text
    return " ".join(parts[:-1]), parts[-1]


def segments(found: list[str], size: int = SEGMENT) -> list[list[str]]:
    """Stretches of equal length (but for one word), at most ``size`` long."""
    k = math.ceil(len(found) / size)
    return [found[i * len(found) // k:(i + 1) * len(found) // k] for i in range(k)]


def shingle_hashes(found: list[str], hashes: WordHash) -> np.ndarray:
    return np.unique(ngram_hashes(hashes.of(found), min(SHINGLE, len(found)))) if found else np.empty(0, np.uint64)


def _terms(batches):
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            for s, part in enumerate(segments(words(text))):
                for term in set(part):
                    rows.append((item, s, len(part), term, part.count(term)))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["item", "segment", "size", "term", "tf"])


@dataclass
class Index:
    """Impacts of one block of items, as shares of the segments' thresholds."""
    term: dict            # word -> number
    owner: np.ndarray     # item (place in ``items``) of each segment
    items: list           # (item_id, shingles of item, question, answer)
    most: np.ndarray      # largest impact of each term
    block_most: np.ndarray  # terms x blocks
    rows: list            # per block: term -> row of its matrix, or -1
    mats: list            # per block: its terms x its segments
    self_score: np.ndarray


def build(postings: list, texts: dict, n_segments: int, mean_size: float, min_score: float) -> Index:
    """From (item, segment, size, term, tf, df) and the items' ids and texts."""
    term, seg = {}, {}
    for r in postings:
        term.setdefault(r["term"], len(term))
        seg.setdefault((r["item"], r["segment"]), len(seg))
    at = np.array([(term[r["term"]], seg[(r["item"], r["segment"])]) for r in postings]).reshape(-1, 2)
    tf, size, df = (np.array([r[c] for r in postings], dtype=float) for c in ("tf", "size", "df"))
    idf = np.log1p((n_segments - df + 0.5) / (df + 0.5))
    impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean_size))
    own = np.bincount(at[:, 1], weights=impact, minlength=len(seg))
    impact = impact / (min_score * own)[at[:, 1]]
    hashes = _Hash()
    keys = list(texts)
    place = {k: i for i, k in enumerate(keys)}
    items = []
    for k in keys:
        item_id, text = texts[k]
        q, a = question_answer(text)
        items.append((item_id, *(shingle_hashes(words(x), hashes) for x in (text, q, a))))
    blocks = math.ceil(len(seg) / SEGMENTS_PER_BLOCK)
    block = at[:, 1] // SEGMENTS_PER_BLOCK
    most, block_most = np.zeros(len(term)), np.zeros((len(term), blocks), dtype=np.float32)
    np.maximum.at(most, at[:, 0], impact)
    np.maximum.at(block_most, (at[:, 0], block), impact.astype(np.float32))
    rows, mats = [], []
    for b in range(blocks):
        k = np.flatnonzero(block == b)
        used, back = np.unique(at[k, 0], return_inverse=True)
        row = np.full(len(term), -1, dtype=np.int32)
        row[used] = np.arange(len(used))
        mat = np.zeros((len(used), SEGMENTS_PER_BLOCK))
        mat[back, at[k, 1] % SEGMENTS_PER_BLOCK] = impact[k]
        rows.append(row)
        mats.append(mat)
    return Index(term, np.array([place[item] for item, _ in seg]), items, most, block_most, rows, mats, own * min_score)


def retrieve(index: Index, texts: list[list[str]]) -> list[dict]:
    """For each text, ``item -> best share of the threshold`` (1 and over) over
    its passages."""
    out = [{} for _ in texts]
    get, step, v = index.term.get, SEGMENT, len(index.term)
    keys, first = [], 0
    owner_doc = []
    for d, found in enumerate(texts):
        t = np.fromiter((get(w, -1) for w in found), dtype=np.int64, count=len(found))
        pos = np.flatnonzero(t >= 0)
        k, passages = pos // step, max(1, math.ceil(len(found) / step))
        keys.append((first + k) * v + t[pos])
        keys.append(((first + k - 1) * v + t[pos])[k > 0])   # the passage that began one step before
        owner_doc.extend([d] * passages)
        first += passages
    keys = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    if not len(keys):
        return out
    passage, term = keys // v, keys % v
    bound = np.bincount(passage, weights=index.most[term], minlength=first)
    able = bound[passage] >= 1 - 1e-6
    passage, term = passage[able], term[able]
    if not len(passage):
        return out
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    ends = np.concatenate([starts[1:], [len(passage)]])
    for lo in range(0, len(starts), 2048):  # bounds the passages x blocks matrix
        s, e = starts[lo:lo + 2048], ends[lo:lo + 2048]
        by_block = np.add.reduceat(index.block_most[term[s[0]:e[-1]]], s - s[0], axis=0)
        for i, b in zip(*np.nonzero(by_block >= 1 - 1e-4)):
            row = index.rows[b][term[s[i]:e[i]]]
            score = index.mats[b][row[row >= 0]].sum(0)
            for j in np.flatnonzero(score >= 1 - 1e-9):
                best = out[owner_doc[passage[s[i]]]]
                seg = b * SEGMENTS_PER_BLOCK + j
                item = int(index.owner[seg])
                if score[j] > best.get(item, (0, 0))[0]:
                    best[item] = (float(score[j]), float(score[j] * index.self_score[seg]))
    return out


def _probe(shared, min_overlap: float, min_part: float):
    share = lambda part, held: float(np.isin(part, held, assume_unique=True).mean()) if len(part) else 0.0

    def run(batches):
        index, hashes = shared.value, _Hash()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [words(t) for t in part.column("text").to_pylist()]
                rows = []
                for d, found in enumerate(retrieve(index, texts)):
                    if not found:
                        continue
                    # shingles, and all shorter ones as items of fewer words are sought whole
                    h = hashes.of(texts[d])
                    held = np.unique(np.concatenate([ngram_hashes(h, n) for n in range(1, SHINGLE + 1)]))
                    for item, (_, score) in found.items():
                        item_id, whole, question, answer = index.items[item]
                        o, q, a = (share(x, held) for x in (whole, question, answer))
                        if o >= min_overlap and q >= min_part and a >= min_part:
                            rows.append((*(part.column(c)[d].as_py() for c in ("doc_id", "rid", "rhash")),
                                         item_id, score, o, q, a))
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.float64()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=[x.split()[0] for x in _HITS.split(", ")])
    return run


_HITS = ("doc_id long, rid long, rhash long, item_id long, score double, overlap double, "
         "question_overlap double, answer_overlap double")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
                 min_overlap: float = MIN_OVERLAP, min_part: float = MIN_PART) -> DataFrame:
    """A row for each training row and test item it holds: ``doc_id, rid, rhash``
    (row key of ``keyed``), ``item_id``, BM25 ``score`` of the best passage, and
    the verified overlaps."""
    spark = docs.sparkSession
    src = keyed(docs, id_col, text_col)
    own = (documents(items, item_id_col, item_text_col).distinct()
           .withColumn("item", F.xxhash64("doc_id", "text")))
    postings = own.mapInArrow(_terms, "item long, segment int, size int, term string, tf int")
    stats = postings.select("item", "segment", "size").distinct().agg(
        F.count("*").alias("n"), F.avg("size").alias("mean"), F.countDistinct("item").alias("items")).first()
    empty = spark.createDataFrame([], _HITS)
    if not stats["n"]:
        return empty
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    passes = math.ceil(stats["items"] / ITEMS_PER_PASS)
    block = F.pmod(F.col("item"), F.lit(passes))
    out = empty
    for p in range(passes):
        rows = postings.filter(block == p).join(df, "term").collect()  # about ITEMS_PER_PASS items
        rows.sort(key=lambda r: (r["item"], r["segment"], r["term"]))
        texts = {r["item"]: (r["doc_id"], r["text"]) for r in own.filter(block == p).collect()}
        index = build(rows, texts, stats["n"], stats["mean"], min_score)
        shared = spark.sparkContext.broadcast(index)
        out = out.union(src.mapInArrow(_probe(shared, min_overlap, min_part), _HITS)) if p else (
            src.mapInArrow(_probe(shared, min_overlap, min_part), _HITS))
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all columns."""
    hit = materialize(contaminated(docs, items, id_col, text_col, **limits).select("rid", "rhash").distinct(), "hits")
    return unpacked(packed(docs, id_col, text_col).join(hit, ["rid", "rhash"], "left_anti"), docs.columns)
