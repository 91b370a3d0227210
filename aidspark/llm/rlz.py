"""Substring deduplication: windows against their first places.

Every document is held against the documents with smaller ids: each window of
``window`` words is joined by its hash with its first place (smallest id, then
smallest position). A factor is a maximal run of windows whose first places
follow one another in one document. This is not a greedy Lempel-Ziv parse of
reference blocks: all windows are looked up, those across the boundary of two
factors as well, so what is removed does not depend on how documents are dealt
to tasks or blocks. A stretch is removed exactly where some window, taken from
the input, also starts in a smaller document.

How it runs: a window's bucket is the smallest hash of its 4-word runs (a
minimizer), so that neighbouring windows mostly share a bucket and travel as one
run. Each task first settles its own documents: a window that a smaller document
of the same task has needs no one else. What is left, at most one document per
window and task, goes to the window's bucket, where the first places of all
tasks are merged. So the windows of a passage that a third of all documents
holds reach its bucket once per task, not once per document. A bucket holds
about ``CHARS_PER_BUCKET`` characters' worth of windows at any input size.

Windows are compared by 64-bit hashes of their words.

Defined cases: null and empty texts have no words; rows with the same id are
versions of one document, which do not shorten each other; a null id sorts after
all others; a repeated row gets the same result twice; a window repeated within
one document only is kept; very long texts are read whole; columns other than
the id and the text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, bucket_count, keyed, ngram_hashes

WINDOW = 13
ANCHOR = 4
CHUNK_WORDS = 1_000_000

_BLOB = pa.schema([
    ("bucket", pa.int32()),
    ("rid", pa.list_(pa.int64())), ("rhash", pa.list_(pa.int64())),        # documents of the row
    ("doc", pa.list_(pa.int32())), ("start", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())),
    ("wins", pa.list_(pa.int64())),                                        # runs of windows to settle
    ("hdoc", pa.list_(pa.int32())), ("hstart", pa.list_(pa.int32())), ("hn", pa.list_(pa.int32())),
    ("href", pa.list_(pa.int64())), ("hat", pa.list_(pa.int32()))])        # runs settled by the task
_BLOB_SQL = ("bucket int, rid array<long>, rhash array<long>, doc array<int>, start array<int>, n array<int>, "
             "wins array<long>, hdoc array<int>, hstart array<int>, hn array<int>, href array<long>, hat array<int>")
_HIT_SQL = "rid long, rhash long, start int, n int, ref_rid long, ref_start int"
_HIT = pa.schema([("rid", pa.int64()), ("rhash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()),
                  ("ref_rid", pa.int64()), ("ref_start", pa.int32())])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:len(x) - step], x[step:])
        done += step
    return x


def _first_places(wins: np.ndarray, rid: np.ndarray, pos: np.ndarray):
    """For each window the id and position of its first place among these."""
    order = np.lexsort((pos, rid, wins))
    w = wins[order]
    head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.empty(0, np.int64)
    size = np.diff(np.concatenate([head, [len(w)]]))
    first_rid, first_pos = np.empty_like(rid), np.empty_like(pos)
    first_rid[order] = np.repeat(rid[order][head], size)
    first_pos[order] = np.repeat(pos[order][head], size)
    return first_rid, first_pos


def _runs(*keys: np.ndarray):
    """Starts and lengths of the stretches over which all keys stay equal."""
    n = len(keys[0])
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    start = np.flatnonzero(new)
    return start, np.diff(np.concatenate([start, [n]]))


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start+1, ... for ``n`` steps of each run, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - start, n)


def _lists(values: np.ndarray, cuts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _settle_chunk(docs: list, hashes: WordHash, window: int, buckets: int):
    """Rows of ``_BLOB`` for (rid, rhash, words) of one chunk of a task."""
    docs = [d for d in docs if len(d[2]) >= window]
    if not docs:
        return None
    rids = np.array([d[0] for d in docs], dtype=np.int64)
    rhashes = np.array([d[1] for d in docs], dtype=np.int64)
    lens = np.array([len(d[2]) for d in docs])
    h = np.concatenate([hashes.of(d[2]) for d in docs])
    base = np.cumsum(lens) - lens
    at = _spread(base, lens - window + 1)               # windows within one document
    doc = np.repeat(np.arange(len(docs), dtype=np.int32), lens - window + 1)
    pos = (at - base[doc]).astype(np.int32)
    wins = ngram_hashes(h, window)[at]
    low = _sliding_min(ngram_hashes(h, ANCHOR), window - ANCHOR + 1)[at]
    del h
    first_rid, first_pos = _first_places(wins, rids[doc], pos)
    known = first_rid < rids[doc]
    # runs settled here
    k = np.flatnonzero(known)
    hs, hn = _runs(doc[k], first_rid[k], k - np.arange(len(k)), first_pos[k] - pos[k])
    hk = k[hs]
    hbucket = (low[hk] % np.uint64(buckets)).astype(np.int64)
    # runs to settle with the other tasks
    o = np.flatnonzero(~known)
    s, n = _runs(doc[o], o - np.arange(len(o)), low[o])
    ok = o[s]
    bucket = (low[ok] % np.uint64(buckets)).astype(np.int64)
    order, horder = np.argsort(bucket, kind="stable"), np.argsort(hbucket, kind="stable")
    ids = np.union1d(bucket, hbucket)
    cuts = np.concatenate([np.searchsorted(bucket[order], ids), [len(order)]])
    hcuts = np.concatenate([np.searchsorted(hbucket[horder], ids), [len(horder)]])
    ok, n, hk, hn = ok[order], n[order], hk[horder], hn[horder]
    ends = np.concatenate([[0], np.cumsum(n)])
    # the documents of each row, numbered anew within it
    rid_l, rhash_l, local, hlocal, dcuts = [], [], np.empty(len(ok), np.int32), np.empty(len(hk), np.int32), [0]
    for i in range(len(ids)):
        a, b, c, d = cuts[i], cuts[i + 1], hcuts[i], hcuts[i + 1]
        used, back = np.unique(np.concatenate([doc[ok[a:b]], doc[hk[c:d]]]), return_inverse=True)
        local[a:b], hlocal[c:d] = back[:b - a], back[b - a:]
        rid_l.append(rids[used])
        rhash_l.append(rhashes[used])
        dcuts.append(dcuts[-1] + len(used))
    i32, i64 = pa.int32(), pa.int64()
    return pa.RecordBatch.from_arrays([
        pa.array(ids, i32), _lists(np.concatenate(rid_l), dcuts, i64), _lists(np.concatenate(rhash_l), dcuts, i64),
        _lists(local, cuts, i32), _lists(pos[ok], cuts, i32), _lists(n.astype(np.int32), cuts, i32),
        _lists(wins[_spread(ok, n)].view(np.int64), ends[cuts], i64),
        _lists(hlocal, hcuts, i32), _lists(pos[hk], hcuts, i32), _lists(hn.astype(np.int32), hcuts, i32),
        _lists(first_rid[hk], hcuts, i64), _lists(first_pos[hk], hcuts, i32)], schema=_BLOB)


def _settle_task(window: int, buckets: int, chunk_words: int):
    def run(batches):
        hashes, chunk, size = WordHash(), [], 0
        for batch in batches:
            for rid, rhash, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "rhash", "text"))):
                words = text.encode().split()
                chunk.append((rid, rhash, words))
                size += len(words)
                if size >= chunk_words:
                    out = _settle_chunk(chunk, hashes, window, buckets)
                    chunk, size = [], 0
                    if out is not None:
                        yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))
        out = _settle_chunk(chunk, hashes, window, buckets)
        if out is not None:
            yield from (out.slice(i, 64) for i in range(0, out.num_rows, 64))
    return run


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten()) for c in column.chunks] or [np.empty(0, np.int64)])


def _settle_bucket(table: pa.Table) -> pa.Table:
    """The runs of a bucket that a smaller document has, of all tasks."""
    docs = np.asarray(table.column("rid").combine_chunks().value_lengths()) if table.num_rows else np.empty(0, int)
    skip = np.cumsum(docs) - docs                       # first document of each row
    rows = lambda c: np.repeat(skip, np.asarray(table.column(c).combine_chunks().value_lengths()))
    rid, rhash = _flat(table.column("rid")), _flat(table.column("rhash"))
    run_doc, start, n = _flat(table.column("doc")) + rows("doc"), _flat(table.column("start")), _flat(table.column("n"))
    wins = _flat(table.column("wins")).view(np.uint64)
    doc, pos = np.repeat(run_doc, n), _spread(start, n).astype(np.int32)
    first_rid, first_pos = _first_places(wins, rid[doc], pos)
    k = np.flatnonzero(first_rid < rid[doc])
    s, m = _runs(doc[k], pos[k] - np.arange(len(k)), first_rid[k], first_pos[k] - pos[k])
    k = k[s]
    hdoc = _flat(table.column("hdoc")) + rows("hdoc")
    both = lambda a, b: np.concatenate([a, b])
    return pa.Table.from_arrays([
        pa.array(both(rid[doc[k]], rid[hdoc])), pa.array(both(rhash[doc[k]], rhash[hdoc])),
        pa.array(both(pos[k], _flat(table.column("hstart"))), pa.int32()),
        pa.array(both(m, _flat(table.column("hn"))), pa.int32()),
        pa.array(both(first_rid[k], _flat(table.column("href")))),
        pa.array(both(first_pos[k], _flat(table.column("hat"))), pa.int32())], schema=_HIT)


def factors(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
            buckets: int | None = None, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Factors of ``window`` words and more: ``rid, rhash`` (row key of
    ``keyed``), ``start``, ``n`` (windows; the factor has ``n + window - 1``
    words), ``ref_rid, ref_start``. Factors of a document may overlap where
    windows lie across a boundary."""
    if window <= ANCHOR:
        raise ValueError(f"the window must be longer than {ANCHOR} words")
    src = keyed(docs, id_col, text_col)
    buckets = buckets or bucket_count(src)
    return (src.select("rid", "rhash", "text").mapInArrow(_settle_task(window, buckets, chunk_words), _BLOB_SQL)
            .groupBy("bucket").applyInArrow(_settle_bucket, _HIT_SQL))


def keep_mask(n_words: int, starts, runs, window: int) -> np.ndarray:
    """False for each word that a factor covers."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(change, np.asarray(starts, dtype=np.int64), 1)
    np.add.at(change, np.minimum(np.asarray(starts, dtype=np.int64) + np.asarray(runs) + window - 1, n_words), -1)
    return np.cumsum(change)[:n_words] == 0


def _cut(window: int):
    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, hits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "hits"))):
                words = text.encode().split()
                kept = words
                if hits:
                    mask = keep_mask(len(words), [h["start"] for h in hits], [h["n"] for h in hits], window)
                    kept = [w for w, k in zip(words, mask.tolist()) if k]
                out = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), out.decode("utf-8", "replace"),
                             hashlib.sha256(out).hexdigest()))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])
    return run


def remove_duplicates(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                      buckets: int | None = None, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_text`` (kept words joined by
    one space) and its ``kept_sha256``."""
    src = keyed(docs, id_col, text_col)
    hits = (factors(docs, window, id_col, text_col, buckets, chunk_words).select("rid", "rhash", F.struct("start", "n").alias("hit"))
            .groupBy("rid", "rhash").agg(F.collect_list("hit").alias("hits")))  # bounded by the document's words
    return (src.join(hits, ["rid", "rhash"], "left").select("doc_id", "text", "hits")
            .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"))
