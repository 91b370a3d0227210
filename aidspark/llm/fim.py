"""Fill-in-the-middle documents by content-defined chunk memoization.

A text is a sequence of units, runs of A-Z letters or single other characters.
A seeded hash of the id draws two cuts between units; prefix, middle and suffix
are written behind markers in one of two orders, or the text stays as it is.

Where the cuts lie depends on how many units the whole text has. To count
them, a rolling hash over ``WINDOW`` bytes cuts the text into chunks of about
``CHUNK`` bytes whose ends depend on the bytes around them alone, so a passage
that many documents share falls into the same chunks in each. A chunk's
boundary summary (units, code points, whether it begins and ends inside a
letter run) is remembered under the chunk's hash; a remembered summary is used
only where the chunk's bytes are equal. Summaries combine: units add up, less
one for each run that goes on over a chunk's end. The prefix sums of a
document's chunks locate the chunk of each cut, and only that chunk is looked
into.

No row is moved: texts are cut where they lie. The memory of a task is bounded
by ``Chunks.LIMIT`` bytes of chunks, whatever the size of the input.

Defined cases: null and empty texts are plain and empty, with 0 units; a text
that holds a marker is plain; a null id draws as the empty text does; repeated
rows come out once each and equal; very long texts are chunked like all others
(a chunk is ``MOST`` bytes at most); an empty table gives no rows; columns
other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import documents

# Fixed by the task: markers, unit pattern, shares of a hundred.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[A-Za-z]+|[^A-Za-z]"
TRANSFORMED, SUFFIX_FIRST = 90, 20

#: Bytes that decide on a chunk's end, the mean size of a chunk and its limits.
WINDOW, CHUNK, LEAST, MOST = 16, 512, 64, 8_192

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Bytes that go on with a code point begun before.
_GOES_ON = np.zeros(256, dtype=bool)
_GOES_ON[0x80:0xC0] = True
_SPREAD = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of the ``WINDOW`` bytes that end at each byte (of fewer at
    the start), by doubling: a window of 2k is one of k and the one before it."""
    h, k, power = _SPREAD[data], 1, _STEP
    while k < WINDOW:
        h = h.copy()
        h[k:] += h[:-k] * power if k < len(h) else np.uint64(0)
        k, power = 2 * k, power * power
    return h


def chunk_ends(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text's bytes, each between two code points."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    with np.errstate(over="ignore"):
        marked = np.flatnonzero((rolling_hash(data) >> np.uint64(40)) % np.uint64(CHUNK) == 0) + 1
    marked = marked[marked < n]
    marked = marked[~_GOES_ON[data[marked]]].tolist()
    ends, at = [], 0
    for end in [*marked, n]:
        while end - at > MOST:  # no marked place for long
            stop = at + MOST
            while _GOES_ON[data[stop]] and stop > at + MOST - 4:
                stop -= 1
            ends.append(stop)
            at = stop
        if end - at >= LEAST or end == n and end > at:
            ends.append(end)
            at = end
    return ends


def unit_starts(data: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a unit starts at each byte; ``inside``: a letter stands before."""
    letter = _LETTER[data]
    before = np.concatenate([[inside], letter[:-1]])
    return np.where(letter, ~before, ~_GOES_ON[data])


class Chunks(dict):
    """hash of a chunk -> (its bytes, its boundary summary), for the chunks a
    worker has met; emptied when they fill ``LIMIT`` bytes."""

    LIMIT = 32_000_000

    def __init__(self):
        super().__init__()
        self.held = self.asked = self.shared = 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """Units, code points, and whether the first and last byte are letters."""
        self.asked += 1
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.get(key)
        if found is not None and found[0] == chunk:  # equal hashes alone do not do
            self.shared += 1
            return found[1]
        data = np.frombuffer(chunk, np.uint8)
        out = (int(np.count_nonzero(unit_starts(data, False))), int(np.count_nonzero(~_GOES_ON[data])),
               bool(_LETTER[data[0]]), bool(_LETTER[data[-1]]))
        if self.held > self.LIMIT:
            self.clear()
            self.held = 0
        self[key] = (chunk, out)
        self.held += len(chunk) + 300
        return out


class Cutter:
    """A text's unit count and the places of its units, from chunk summaries."""

    def __init__(self, text: bytes, chunks: Chunks):
        self.text, data = text, np.frombuffer(text, np.uint8)
        self.ends = chunk_ends(data)
        self.begins = [0, *self.ends[:-1]] if self.ends else []
        found = [chunks.summary(text[a:b]) for a, b in zip(self.begins, self.ends)]
        #: Whether a letter run goes on into the chunk.
        self.inside = [False, *(a[3] and b[2] for a, b in zip(found, found[1:]))] if found else []
        self.units = np.cumsum([0] + [s[0] - i for s, i in zip(found, self.inside)])
        self.chars = np.cumsum([0] + [s[1] for s in found])
        self.n = int(self.units[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """Byte and code point where the first ``units`` units end."""
        if units >= self.n:
            return len(self.text), int(self.chars[-1])
        # the chunk in which the next unit starts
        i = int(np.searchsorted(self.units, units, side="right")) - 1
        data = np.frombuffer(self.text[self.begins[i]:self.ends[i]], np.uint8)
        at = int(np.flatnonzero(unit_starts(data, self.inside[i]))[units - int(self.units[i])])
        return self.begins[i] + at, int(self.chars[i]) + int(np.count_nonzero(~_GOES_ON[data[:at]]))


def draws(id_: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])
_MEMO = Chunks()  # of this worker process, shared by its tasks


def _transform(transformed: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        p, s, m = marks
        for batch in batches:
            rows, size = [], 0
            for doc_id, data, h1, h2, h3, h4 in zip(*(batch.column(c) for c in ("doc_id", "data", "h1", "h2", "h3", "h4"))):
                doc_id, text = doc_id.as_py(), data.as_py()
                h1, h2, h3, h4 = h1.as_py(), h2.as_py(), h3.as_py(), h4.as_py()
                cutter = Cutter(text, _MEMO)
                if not text or any(x in text for x in marks) or h3 % 100 >= transformed:
                    rows.append((doc_id, cutter.n, "plain", None, None, text))
                else:
                    a, b = sorted((h1 % (cutter.n + 1), h2 % (cutter.n + 1)))
                    (x, xc), (y, yc) = cutter.cut(a), cutter.cut(b)
                    head, mid, tail = text[:x], text[x:y], text[y:]
                    if h4 % 100 < suffix_first:
                        rows.append((doc_id, cutter.n, "spm", xc, yc - xc, b"".join((s, tail, p, head, m, mid))))
                    else:
                        rows.append((doc_id, cutter.n, "psm", xc, yc - xc, b"".join((p, head, s, tail, m, mid))))
                size += len(text)
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
    return run


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n`` (units), ``form`` (plain, psm or spm), ``prefix_chars,
    middle_chars`` (code points; null if plain) and ``output`` of every row;
    ``transformed`` of a hundred texts are cut, ``suffix_first`` of a hundred of
    these have their suffix first."""
    src = documents(docs, id_col, text_col)
    src = src.select("doc_id", F.col("text").cast("binary").alias("data"),
                     *[h.alias(f"h{i + 1}") for i, h in enumerate(draws(F.col("doc_id"), seed))])
    return src.mapInArrow(_transform(transformed, suffix_first), _OUT).withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. Parts hold no marker, and none can
    arise over a part's end, so the first one found is the one written."""
    def parts(first: str, second: str):
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    head, tail, mid = parts(PREFIX, SUFFIX)
    tail2, head2, mid2 = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(head, mid, tail)).when(form == "spm", F.concat(head2, mid2, tail2))
            .otherwise(output))


#: The query ``op11_fim`` in DuckDB SQL.
ORACLE_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
numbers AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
         ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
  FROM drawn),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
