"""Line and passage deduplication by winnowing.

A document is the sequence of its lines that are not blank, compared without the
white space around them. In every window of ``run_lines`` consecutive lines the
smallest line hash (the rightmost of equal ones) is a fingerprint, so any run of
so many lines that occurs twice shares a fingerprint at the same place in it.
Fingerprints found at more than one place are joined with all their places; each
is extended both ways by the windows that selected it, and a window that starts
at an earlier place as well marks its lines as repeated. Places are ordered by
document id, then by line; the first copy stays, later runs are deleted,
within a document too. Overlapping windows add up to runs of any length.

Only minima and counts are taken per fingerprint and per window (with partial
sums in each task) and joined back, so a line that a third of all documents
holds is never gathered.

``dedup_passages`` does the same below the line, for passages of
``passage_words`` words and more wherever they lie (inside longer lines, across
line breaks, in a lone line). Its unit is the word: the fingerprints are minima
of word grams, a window of ``passage_words`` words around a shared fingerprint
that occurs at an earlier place marks its words, and overlapping windows extend
a match both ways to the word. Line breaks and other white space neither match
nor separate; the white space around removed words stays. A window that its own
document has before is marked there and not shuffled.

Defined cases: null and empty texts have no lines; blank lines neither match nor
separate, and stay; a text with fewer than ``run_lines`` lines is left alone; a
null id sorts after all others; rows that repeat an id and text are one document
and get the same result; very long texts and lines are read whole; columns other
than the id and the text pass through unread, whatever their names; an empty
table gives no rows. Lines are compared by 64-bit hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, keyed, materialize, ngram_hashes, packed

RUN_LINES = 2
PASSAGE_WORDS = 50
#: Words of the grams that passages are fingerprinted by.
GRAM_WORDS = 10
_BLANK = " \t\r\x0b\x0c"
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def line_hashes(text: str) -> np.ndarray:
    lines = [s for s in (x.strip(_BLANK) for x in text.split("\n")) if s]
    return np.fromiter((xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in lines),
                       dtype=np.uint64, count=len(lines))


def selected(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window of line hashes the line it selects."""
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.arange(len(view)) + window - 1 - np.argmin(view[:, ::-1], axis=1)


def _fingerprints(window: int):
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for rid, rhash, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "rhash", "text"))):
                h = line_hashes(text)
                if len(h) < window:
                    continue
                for col, v in zip(out, (np.full(len(h) - window + 1, rid), np.full(len(h) - window + 1, rhash),
                                        np.arange(len(h) - window + 1), h[selected(h, window)].view(np.int64),
                                        ngram_hashes(h, window).view(np.int64))):
                    col.append(v)
            if out[0]:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(out, kinds)],
                                                 names=["rid", "rhash", "start", "print", "run"])
    return run


def repeated_runs(docs: DataFrame, run_lines: int = RUN_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid, rhash`` (row key of ``keyed``) and ``starts``: the windows of
    ``run_lines`` lines that an earlier place has too."""
    src = keyed(docs, id_col, text_col).select("rid", "rhash", "text")
    found = materialize(src.mapInArrow(_fingerprints(run_lines), "rid long, rhash long, start int, print long, run long")
                        .select(F.struct("rid", "rhash", "start").alias("place"), "print", "run"), "fingerprints")
    # fingerprints at more than one place
    shared = (found.groupBy("print").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
              .filter("lo < hi").select("print"))
    windows = found.join(shared, "print", "left_semi")
    first = windows.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    return (windows.join(first.select("run", "first"), "run").filter("place > first")
            .groupBy("place.rid", "place.rhash").agg(F.collect_set("place.start").alias("starts")))


def kept_lines(text: str, starts, run_lines: int) -> tuple[str, int, int]:
    """The text without the lines of the marked windows, its number of lines
    and of those deleted."""
    gone = {s + i for s in (starts if starts is not None else ()) for i in range(run_lines)}
    out, at = [], 0
    for line in text.split("\n"):
        if line.strip(_BLANK):
            if at not in gone:
                out.append(line)
            at += 1
        else:
            out.append(line)
    return "\n".join(out) if gone else text, at, len(gone)


def dedup_lines(docs: DataFrame, run_lines: int = RUN_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, ``text_col`` without its repeated runs
    (null where it was null), and a struct column ``line_dedup`` (``n_lines,
    n_removed``) in place of one of that name."""
    if run_lines < 1:
        raise ValueError("run_lines must be at least 1")

    @F.pandas_udf("text string, n_lines long, n_removed long")
    def cut(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([kept_lines(t or "", s, run_lines) for t, s in zip(text, starts)],
                            columns=["text", "n_lines", "n_removed"])

    # not deterministic for the optimizer: a filter on the counts would else be moved
    # below and cut every text a second time, in a second worker of each task
    runs = repeated_runs(docs, run_lines, id_col, text_col)
    done = (packed(docs, id_col, text_col).join(runs, ["rid", "rhash"], "left")
            .withColumn("cut", cut.asNondeterministic()(F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")), "starts")))
    cols = [F.when(F.col("row")[c].isNotNull(), F.col("cut.text")).alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in docs.columns if c != "line_dedup"]
    return done.select(*cols, F.struct("cut.n_lines", "cut.n_removed").alias("line_dedup"))


def passage_prints(words: np.ndarray, window: int) -> np.ndarray:
    """For each window of word hashes its fingerprint, the smallest of its grams."""
    if len(words) < window:
        return np.empty(0, np.int64)
    gram = min(GRAM_WORDS, window)
    low, reach, want = ngram_hashes(words, gram), 1, window - gram + 1
    while reach < want:  # minima of windows that double up to the wanted reach
        step = min(reach, want - reach)
        low, reach = np.minimum(low[:-step], low[step:]), reach + step
    return low.view(np.int64)


def _passage_prints(window: int):
    def run(batches):
        hashes = WordHash()
        for batch in batches:
            out = [[], [], [], []]
            for rid, rhash, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "rhash", "text"))):
                words = hashes.of(text.encode("utf-8", "surrogatepass").split())
                found = passage_prints(words, window)
                if not len(found):
                    continue
                own, runs = np.unique(found, return_inverse=True)
                # a window that the document has twice makes its fingerprint shared
                wins, n = np.unique(ngram_hashes(words, window), return_inverse=True, return_counts=True)[1:]
                twice = np.bincount(runs, weights=n[wins] > 1, minlength=len(own)) > 0
                for col, v in zip(out, (np.full(len(own), rid), np.full(len(own), rhash), own, twice)):
                    col.append(v)
            if out[0]:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(out, kinds)],
                                                 names=["rid", "rhash", "print", "twice"])
    return run


def _passage_windows(window: int):
    names, kinds = ["rid", "rhash", "start", "run", "again"], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(out, kinds)], names=names)

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            out, held = [[] for _ in kinds], 0
            for rid, rhash, text, prints in zip(*(batch.column(c).to_pylist() for c in ("rid", "rhash", "text", "prints"))):
                words = hashes.of(text.encode("utf-8", "surrogatepass").split())
                at = np.flatnonzero(np.isin(passage_prints(words, window), np.array(prints, dtype=np.int64)))
                wins = ngram_hashes(words, window).view(np.int64)[at]
                again = np.ones(len(at), dtype=bool)
                again[np.unique(wins, return_index=True)[1]] = False
                for col, v in zip(out, (np.full(len(at), rid), np.full(len(at), rhash), at, wins, again)):
                    col.append(v)
                held += len(at)
                if held >= 200_000:
                    yield rows(out)
                    out, held = [[] for _ in kinds], 0
            if held:
                yield rows(out)
    return run


def repeated_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``rid, rhash`` (row key of ``keyed``) and ``starts``: the windows of
    ``passage_words`` words that an earlier place has too."""
    src = keyed(docs, id_col, text_col).select("rid", "rhash", "text")
    found = materialize(src.mapInArrow(_passage_prints(passage_words), "rid long, rhash long, print long, twice boolean"),
                        "passage-prints")
    doc = F.struct("rid", "rhash")
    shared = (found.groupBy("print").agg(F.min(doc).alias("lo"), F.max(doc).alias("hi"), F.max("twice").alias("twice"))
              .filter("lo < hi or twice").select("print"))
    zones = (found.join(shared, "print", "left_semi").groupBy("rid", "rhash")
             .agg(F.collect_set("print").alias("prints")))  # bounded by the document's words
    windows = materialize(src.join(zones, ["rid", "rhash"])
                          .mapInArrow(_passage_windows(passage_words), "rid long, rhash long, start int, run long, again boolean"),
                          "passage-windows")
    once = windows.filter("not again").select(F.struct("rid", "rhash", "start").alias("place"), "run")
    first = once.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    later = once.join(first.select("run", "first"), "run").filter("place > first").select("place.*")
    return (later.unionByName(windows.filter("again").select("rid", "rhash", "start"))
            .groupBy("rid", "rhash").agg(F.collect_set("start").alias("starts")))


def kept_words(text: str, starts, window: int) -> tuple[str, int, int]:
    """The text without the words of the marked windows, its number of words
    and of those deleted."""
    if starts is None:
        return text, len(text.encode("utf-8", "surrogatepass").split()), 0
    spans = [m.span() for m in _WORD.finditer(text)]
    change = np.zeros(len(spans) + 1, dtype=np.int64)
    np.add.at(change, np.asarray(starts, dtype=np.int64), 1)
    np.add.at(change, np.asarray(starts, dtype=np.int64) + window, -1)
    gone = np.cumsum(change)[:len(spans)] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(edge[::2], edge[1::2]):
        out.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return "".join([*out, text[at:]]), len(spans), int(gone.sum())


def dedup_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, ``text_col`` without its repeated passages
    (null where it was null), and a struct column ``passage_dedup`` (``n_words,
    n_removed``) in place of one of that name."""
    if passage_words < 1:
        raise ValueError("passage_words must be at least 1")

    @F.pandas_udf("text string, n_words long, n_removed long")
    def cut(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([kept_words(t or "", s, passage_words) for t, s in zip(text, starts)],
                            columns=["text", "n_words", "n_removed"])

    # evaluated once, as in dedup_lines
    runs = repeated_passages(docs, passage_words, id_col, text_col)
    done = (packed(docs, id_col, text_col).join(runs, ["rid", "rhash"], "left")
            .withColumn("cut", cut.asNondeterministic()(F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")), "starts")))
    cols = [F.when(F.col("row")[c].isNotNull(), F.col("cut.text")).alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in docs.columns if c != "passage_dedup"]
    return done.select(*cols, F.struct("cut.n_words", "cut.n_removed").alias("passage_dedup"))


#: The same deletions in DuckDB SQL, for windows of two lines.
ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
keys AS (SELECT doc_id, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k FROM lines),
solid AS (SELECT doc_id, i, k, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM keys WHERE k <> ''),
pairs AS (SELECT doc_id, p, k, lead(k) OVER (PARTITION BY doc_id ORDER BY p) AS k2 FROM solid),
later AS (SELECT doc_id, p FROM
            (SELECT doc_id, p, row_number() OVER (PARTITION BY k, k2 ORDER BY doc_id, p) AS nth FROM pairs WHERE k2 IS NOT NULL)
          WHERE nth > 1),
gone AS (SELECT doc_id, p FROM later UNION SELECT doc_id, p + 1 FROM later),
marked AS (SELECT keys.doc_id, keys.i, keys.line, solid.p AS p, gone.p IS NOT NULL AS gone
           FROM keys LEFT JOIN solid ON keys.doc_id = solid.doc_id AND keys.i = solid.i
                     LEFT JOIN gone ON solid.doc_id = gone.doc_id AND solid.p = gone.p)
SELECT doc_id, count(p) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
