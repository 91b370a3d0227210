"""Quality rules by distribution divergence.

For each language the corpus gives two references: the share of each character
class, and the share of each of the language's ``top_words`` commonest words
(the rest of the words form one more bin). A document is compared with the
references of its language by the Jensen-Shannon distance (base 2, so 0 to 1).
It fails where a distance is over its limit, unless it is shorter than the
rule's minimum: short texts have noisy histograms and are let pass.

The references are counted over all documents: each task counts the 64-bit
hashes of its words and sends (language, hash, count) partial sums, Spark adds
them up, and only the top words of each language reach the driver. Beside its
hash a word carries its first 15 bytes and its length as two numbers, which put
equally common words in order and spell the shorter ones; longer words among the
top are looked up in the texts.

Defined cases: a null or empty text has no words and all counts 0; a null
language, or one with fewer than ``min_reference_words`` words in the corpus,
is compared with the reference of all documents; ties among the commonest words
go by the word (its first 15 bytes, then its hash); repeated rows are judged and
counted each; very long texts are judged whole; columns other than the three
named are not read; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, materialize, ngram_hashes, short_batches

CLASSES = ("lower", "upper", "digit", "space", "newline", "punctuation", "symbol", "letter", "other")
# Fixed by the task: the symbol characters, and the words of a repeat window.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
_SPACES = b" \t\n\r\x0b\x0c"
_TABLE_END = 0x3000


@dataclass(frozen=True)
class Rules:
    top_words: int = 100
    min_reference_words: int = 10_000
    max_languages: int = 2_000
    min_chars: int = 200
    max_class_distance: float = 0.29
    min_words: int = 100
    max_word_distance: float = 0.42
    base_min_words: int = 50


def _class_table() -> np.ndarray:
    """Class of each code point below ``_TABLE_END``; those beyond count as
    letters (they are, nearly all)."""
    def cls(cp):
        c = chr(cp)
        if c == "\n":
            return 4
        if cp < 128 and c.encode() in _SPACES or unicodedata.category(c) == "Zs":
            return 3
        if c in SYMBOLS:
            return 6
        cat = unicodedata.category(c)
        if cp < 128:
            return {"Ll": 0, "Lu": 1, "Nd": 2}.get(cat, 5 if cat[0] in "PS" else 8)
        return {"Ll": 0, "Lu": 1, "L": 7, "N": 2, "P": 5, "S": 6, "M": 7}.get(cat, {"L": 7, "N": 2, "P": 5, "S": 6, "M": 7}.get(cat[0], 8))
    return np.array([cls(cp) for cp in range(_TABLE_END)], dtype=np.uint8)


def class_counts(text: str, table: np.ndarray) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.bincount(np.where(cps < _TABLE_END, table[np.minimum(cps, _TABLE_END - 1)], 7),
                       minlength=len(CLASSES))


def repeated_words(hashes: np.ndarray, n: int = REPEAT_WINDOW) -> int:
    """Words inside an ``n``-word window that is found twice or more."""
    grams = ngram_hashes(hashes, n)
    if not len(grams):
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(hashes), dtype=bool)
    for i in range(n):
        covered[i:i + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            n += line in seen
            seen.add(line)
    return n


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms (any positive totals)."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


#: Bytes of a word that travel with its hash, and entries that a task holds back.
SPELLED = 15
HELD_BACK = 400_000


def spelling(words: list[bytes]) -> np.ndarray:
    """Two signed numbers a word that sort like its first ``SPELLED`` bytes and then
    its length, of which longer words have ``SPELLED + 1``."""
    packed = b"".join(w[:SPELLED].ljust(SPELLED, b"\0") + bytes((min(len(w), SPELLED + 1),)) for w in words)
    return (np.frombuffer(packed, ">u8") ^ np.uint64(1 << 63)).astype(np.int64).reshape(-1, 2)


def spelled(first: int, second: int) -> bytes | None:
    """The word of two such numbers, None if it is longer than they tell."""
    data = b"".join(((n & (1 << 64) - 1) ^ 1 << 63).to_bytes(8, "big") for n in (first, second))
    return data[:data[-1]] if data[-1] <= SPELLED else None


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, spelling, count) arrays with each hash once."""
    h, s, n = (np.concatenate(x) for x in zip(*parts))
    u, at, back = np.unique(h, return_index=True, return_inverse=True)
    return u, s[at], np.bincount(back, weights=n, minlength=len(u)).astype(np.int64)


_COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("item", pa.int64()), ("s1", pa.int64()),
                     ("s2", pa.int64()), ("n", pa.int64())])


def _count(batches):
    """(language, word or class, count) partial sums of a task."""
    table, hashes, words, classes = _class_table(), WordHash(), {}, {}
    held = 0

    def flush():
        for lang, parts in words.items():
            h, s, n = _merged(parts)
            for at in range(0, len(h), 50_000):
                few = slice(at, at + 50_000)
                k = len(h[few])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array(np.zeros(k, np.int32)),
                                                  pa.array(h[few].view(np.int64)), pa.array(s[few, 0].copy()),
                                                  pa.array(s[few, 1].copy()), pa.array(n[few])], schema=_COUNTS)
        rows = [(lang, 1, i, 0, 0, int(n)) for lang, c in classes.items() for i, n in enumerate(c) if n]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _COUNTS)], schema=_COUNTS)
        words.clear()
        classes.clear()

    def add(lang, found):
        h = hashes.of(found)
        u, at, n = np.unique(h, return_index=True, return_counts=True)
        parts = words.setdefault(lang, [])
        parts.append((u, spelling([found[i] for i in at.tolist()]), n))
        return len(u)

    for batch in batches:
        waiting: dict = {}
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            lang, text = lang.as_py(), text.as_py()
            c = classes.setdefault(lang, np.zeros(len(CLASSES), dtype=np.int64))
            c += class_counts(text, table)
            some = waiting.setdefault(lang, [])
            some += text.encode().split()
            if len(some) > 100_000:
                held += add(lang, waiting.pop(lang))
        held += sum(add(lang, some) for lang, some in waiting.items() if some)
        if held > 4 * HELD_BACK:
            for lang, parts in words.items():
                words[lang] = [_merged(parts)]
            held = sum(len(p[0][0]) for p in words.values())
            if held > HELD_BACK:
                yield from flush()
                held = 0
    yield from flush()


def _spell(wanted):
    """(hash, word) of the wanted hashes that a task meets."""
    def run(batches):
        hashes, left = WordHash(), set(wanted.value)
        for batch in batches:
            found = {}
            for text in batch.column("text"):
                for w in set(text.as_py().encode().split()):
                    if len(w) > SPELLED and hashes[w] in left:
                        found[hashes[w]] = w
            left -= found.keys()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(list(found), np.uint64).view(np.int64)),
                                                  pa.array(list(found.values()), pa.binary())], names=["item", "word"])
    return run


@dataclass
class References:
    """Per language (None: all documents): class counts, common words and their
    counts with the other words' count at the end."""
    classes: dict = field(default_factory=dict)
    words: dict = field(default_factory=dict)

    def of(self, lang):
        return lang if lang in self.words else None


def _source(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return short_batches(docs).select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       docs[lang_col].cast("string").alias("lang"))


def fit_references(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang") -> References:
    src = _source(docs, id_col, text_col, lang_col)
    counts = materialize(src.mapInArrow(_count, "lang string, kind int, item long, s1 long, s2 long, n long")
                         .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"), F.min("s1").alias("s1"), F.min("s2").alias("s2")),
                         "references")
    big = (counts.filter("kind = 0 AND lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= rules.min_reference_words).limit(rules.max_languages + 1).collect())
    if len(big) > rules.max_languages:
        raise ValueError(f"more than {rules.max_languages} languages")
    totals = {r["lang"]: r["n"] for r in big}
    own = counts.filter(F.col("lang").isin(list(totals)))
    everyone = counts.groupBy("kind", "item").agg(F.sum("n").alias("n"), F.min("s1").alias("s1"), F.min("s2").alias("s2"))
    order = [F.desc("n"), "s1", "s2", "item"]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    common: dict = {lang: [] for lang in [*totals, None]}
    for r in (own.filter("kind = 0").withColumn("rank", rank).filter(F.col("rank") <= rules.top_words)
              .orderBy("lang", "rank").collect()):
        common[r["lang"]].append(r)
    common[None] = everyone.filter("kind = 0").orderBy(*order).limit(rules.top_words).collect()
    totals[None] = everyone.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    long = {r["item"] & (1 << 64) - 1 for rows in common.values() for r in rows if spelled(r["s1"], r["s2"]) is None}
    words = {}
    if long:  # at most top_words a language
        wanted = docs.sparkSession.sparkContext.broadcast(frozenset(long))
        found = src.select("text").mapInArrow(_spell(wanted), "item long, word binary")
        words = {r["item"]: bytes(r["word"]) for r in found.groupBy("item").agg(F.min("word").alias("word")).collect()}
    out = References()
    for lang, total in totals.items():
        top = [words[r["item"]] if spelled(r["s1"], r["s2"]) is None else spelled(r["s1"], r["s2"]) for r in common[lang]]
        n = [r["n"] for r in common[lang]]
        out.words[lang] = ({w: i for i, w in enumerate(top)}, np.array(n + [total - sum(n)], dtype=float))
        out.classes[lang] = np.zeros(len(CLASSES))
    for r in own.filter("kind = 1").collect():
        out.classes[r["lang"]][r["item"]] = r["n"]
    for r in everyone.filter("kind = 1").collect():
        out.classes[None][r["item"]] = r["n"]
    return out


_OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, class_distance double, word_distance double")


def _measure(shared, rules: Rules):
    def run(batches):
        refs, table, hashes = shared.value, _class_table(), WordHash()
        for batch in batches:
            rows = []
            for doc_id, text, lang in zip(*(batch.column(c) for c in ("doc_id", "text", "lang"))):
                doc_id, text, lang = doc_id.as_py(), text.as_py(), lang.as_py()  # one text at a time
                words, lang = text.encode().split(), refs.of(lang)
                classes = class_counts(text, table)
                spaces = sum(text.count(c) for c in _SPACES.decode())
                by_class = by_word = None
                if len(text) >= rules.min_chars and refs.classes[lang].sum():
                    by_class = js_distance(classes.astype(float), refs.classes[lang])
                place, ref = refs.words[lang]
                if len(words) >= max(1, rules.min_words) and ref.sum():
                    own = np.zeros(len(ref))
                    for w, n in Counter(words).items():
                        own[place.get(w, -1)] += n
                    by_word = js_distance(own, ref)
                rows.append((doc_id, len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS),
                             duplicate_lines(text), repeated_words(hashes.of(words)), by_class, by_word))
            if rows:
                types = [pa.int64()] * 6 + [pa.float64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=[x.split()[0] for x in _OUT.split(", ")])
    return run


def judge(docs: DataFrame, rules: Rules = Rules(), references: References | None = None,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, distances (null where a guard let the document pass),
    ``base_failed`` and ``kept`` of every row."""
    refs = references or fit_references(docs, rules, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(refs)  # at most max_languages * top_words entries
    found = _source(docs, id_col, text_col, lang_col).mapInArrow(_measure(shared, rules), _OUT)
    base = (F.col("n_words") < rules.base_min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > rules.max_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > rules.max_word_distance)
    return found.withColumn("base_failed", base).withColumn("kept", ~base & ~far)
