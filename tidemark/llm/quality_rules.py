"""Distribution divergence: character-class and common-word histograms against language references.

Every document gets two histograms, of its characters over eight classes and of its words over the
common words of all languages known here. The reference of a language is the mean of the histograms, as shares, of the
distinct texts of all its documents that pass the base rules, the judged text left out: a long text weighs no more than
a short one, copies count once, and no text is held against itself. Where fewer than ``MIN_DOCS`` other texts are left,
the reference is that of all languages together. A document is held against its reference by
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1). Documents too short for a
histogram to mean anything aren't judged by it (minimum-length guards).

Defined results: a null or empty text has no words and fails the base rules; a null language has the reference of all
languages together; a text that is the only one to pass the base rules has no reference and its distances are null;
repeated rows are judged row by row and alike; an empty table gives no rows; other columns are left as they are in
``judge`` (internal names avoid theirs). A text under two languages counts once in each.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, free, join_small, per_text, quoted, table, written

# The common words of each language.
COMMON = {
    "en": "the of and to in a is that it for was on as with be by this are from at",
    "de": "der die und das von den mit zu ist im nicht auf ein eine dem des sich als auch für",
    "es": "de la que el en y los del las un por con no una se para su al lo como",
    "fr": "de la le et les des en un du une que est pour qui dans par pas au sur avec",
}
WORDS = sorted({w for words in COMMON.values() for w in words.split()})
# Classes by first and last code points; what is in none of them is of the last class.
CLASSES = {
    "space": ((0x09, 0x0D), (0x20, 0x20)),
    "lower": ((0x61, 0x7A),),
    "upper": ((0x41, 0x5A),),
    "digit": ((0x30, 0x39),),
    "stop": ((0x21, 0x22), (0x27, 0x29), (0x2C, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)),
    "symbol": ((0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
    "latin": ((0xC0, 0x24F),),
    "other": (),
}
TRIMMED = b".,;:!?\"'()"
MIN_CHARS, MIN_WORDS = 200, 60
#: Greatest distances of a kept document; short texts are farther from any reference by chance, by about one over
#: the root of their words.
MAX_CHARS, MAX_WORDS, WORDS_SLACK = 0.25, 0.2, 1.0
MIN_BASE_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
#: Least number of other distinct texts that a language's own reference is made of.
MIN_DOCS = 10
#: Shares are added up as whole numbers of this part, so sums don't depend on their order.
SCALE = 2**24

_word, _symbol = re.compile(WORD), re.compile(r"[#*$%&|<>]")
_index = {w.encode(): k for k, w in enumerate(WORDS)}
_OUT = "n_chars long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars array<long>, words array<long>"


def _by_code() -> np.ndarray:
    out = np.full(0x251, len(CLASSES) - 1, np.int64)
    for k, ranges in enumerate(CLASSES.values()):
        for first, last in ranges:
            out[first : last + 1] = k
    return out


_class = _by_code()


def char_histogram(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_class[np.minimum(codes, 0x250)], minlength=len(CLASSES))


def word_histogram(counts: dict[bytes, int]) -> list[int]:
    """Counts of the common words, upper-case ASCII letters read as lower-case; the last bin has all other words."""
    out = [0] * (len(WORDS) + 1)
    for word, n in counts.items():
        k = _index.get(word.strip(TRIMMED).lower())
        if k is not None:
            out[k] += n
    out[-1] = sum(counts.values()) - sum(out)
    return out


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more. A repeated window has repeated pairs of words only, which rules
    out most texts. Windows are numbered by doubling (pairs, fours, eights): equal numbers are equal windows, no hash."""
    if len(ids) <= window:
        return 0
    pairs = ids[:-1] * (ids.max() + 1) + ids[1:]
    ordered = np.sort(pairs)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    twice = again[np.minimum(np.searchsorted(again, pairs), len(again) - 1)] == pairs
    if not np.logical_and.reduce([twice[k : len(ids) - window + 1 + k] for k in range(window - 1)]).any():
        return 0
    span = 1
    while span < window:
        ids = np.unique(ids[:-span] * (ids.max() + 1) + ids[span:], return_inverse=True)[1]
        span *= 2
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(len(ids) + window, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if _word.search(line):
            n += line in seen
            seen.add(line)
    return n


def measure(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()  # of bytes: at ASCII white space only
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    chars = char_histogram(text)
    return (
        len(text), len(words), len(text) - int(chars[0]), len(_symbol.findall(text)), duplicate_lines(text), repeated_words(ids), chars,
        word_histogram(dict(zip(number, np.bincount(ids).tolist()))),
    )


measured = per_text(measure, _OUT)


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_BASE_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED_PERCENT * F.col(f"{m}.n_words"))


def shares(m: str, h: str, n: str) -> Column:
    """A histogram as whole parts of SCALE; its sum ``n`` is over 0."""
    return F.transform(F.col(f"{m}.{h}"), lambda c: F.floor(F.lit(SCALE) * c / F.col(f"{m}.{n}")))


def references(measures: DataFrame, m: str, text_hash: str, lang: str) -> tuple[DataFrame, dict]:
    """Summed shares of the distinct texts that pass the base rules: one row (language, docs, chars, words) per language,
    and the same of all of them together (a fixed number of values). Copies go map-side, before the shuffle."""
    sizes = {"chars": len(CLASSES), "words": len(WORDS) + 1}
    parts = F.struct(shares(m, "chars", "n_chars").alias("chars"), shares(m, "words", "n_words").alias("words"))
    passed = measures.where(~base_failed(m)).select(quoted(lang).alias("language"), F.col(text_hash).alias("t"), parts.alias("s"))
    texts = passed.groupBy("language", "t").agg(F.first("s").alias("s"))
    bins = [(h, k) for h, n in sizes.items() for k in range(n)]
    per = written(texts.groupBy("language").agg(F.count("*").alias("docs"), *[F.sum(F.col(f"s.{h}")[k]).alias(f"{h}{k}") for h, k in bins]))
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per.columns[1:]]).first()
    whole = {"docs": total["docs"]} | {h: [total[f"{h}{k}"] for k in range(n)] for h, n in sizes.items()}
    return per.where("language is not null").select("language", "docs", *[F.array(*[f"{h}{k}" for k in range(n)]).alias(h) for h, n in sizes.items()]), whole


def js_distance(counts: Column, n: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of a histogram with sum ``n`` (over 0) from a distribution."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(x * 2 / (x + y))).otherwise(0.0)

    terms = F.zip_with(counts, shares, lambda x, y: (part(x / n, y) + part(y, x / n)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def judge(docs: DataFrame, out: str, text: str = "text", lang: str = "lang", keep_text: bool = True) -> DataFrame:
    """The documents with a struct column ``out``: the base counts, ``base_failed``, the two distances (null where
    the length guard holds them back) and ``kept``. The texts are measured once, into a written table (without the
    texts unless ``keep_text``); they are never shuffled."""
    m, text_hash = free(docs, "measured"), free(docs, "text_hash")
    docs = docs.withColumns({m: measured(quoted(text)), text_hash: F.xxhash64(quoted(text))})
    docs = written(docs if keep_text else docs.drop(text))
    refs, total = references(docs, m, text_hash, lang)
    refs = refs.select(F.struct("language", "docs", "chars", "words").alias(ref := free(docs, "reference")))
    with_ref = join_small(docs, refs, quoted(lang) == F.col(f"{ref}.language"))
    failed = base_failed(m)
    own = F.when(failed, 0).otherwise(1)  # texts that failed are in no reference
    others = F.coalesce(F.col(f"{ref}.docs"), F.lit(0)) - own
    known = others >= MIN_DOCS
    n_docs = F.when(known, others).otherwise(F.lit(total["docs"]) - own)

    def distance(h: str, n: str, enough: Column) -> Column:
        sums = F.when(known, F.col(f"{ref}.{h}")).otherwise(F.array(*[F.lit(x).cast("long") for x in total[h]]))
        q = F.zip_with(sums, shares(m, h, n), lambda x, y: (x - y * own) / n_docs / SCALE)
        return F.when(enough & (n_docs > 0), js_distance(F.col(f"{m}.{h}"), F.col(f"{m}.{n}"), q))

    chars, words = distance("chars", "n_chars", F.col(f"{m}.word_chars") >= MIN_CHARS), distance("words", "n_words", F.col(f"{m}.n_words") >= MIN_WORDS)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    near = (F.coalesce(chars, F.lit(0.0)) <= MAX_CHARS) & (F.coalesce(words, F.lit(0.0)) <= MAX_WORDS + WORDS_SLACK / F.sqrt(F.col(f"{m}.n_words")))
    verdict = F.struct(*[F.col(f"{m}.{c}").alias(c) for c in fields], failed.alias("base_failed"), chars.alias("js_chars"), words.alias("js_words"), (~failed & near).alias("kept"))
    return with_ref.withColumn(out, verdict).drop(m, text_hash, ref)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(docs, "verdict", keep_text=False).select("doc_id", *[f"verdict.{c}" for c in names])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the kept documents."""
    return judge(docs, out := free(docs, "verdict")).where(F.col(f"{out}.kept")).drop(out)
