"""Quality rules: how far a text's histograms are from those of its language."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from uptrail.llm.common import LOWER, Rolling, SPACE, mix, slices, utf8, word_bounds, written

# Common words of four languages, and the characters that count as symbols.
COMMON = {
    "en": "the be to of and a in that have it for not on with as at this by from they is are an or was",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il elle",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero mi",
}
SYMBOLS = "#*$%&|<>"
WORDS = sorted({w for words in COMMON.values() for w in words.split()})
#: Classes of characters, by their first byte in UTF-8; the last is everything else.
CLASSES = ["lower", "upper", "digit", "blank", "stop", "quote", "symbol", "latin", "two", "three", "four", "other"]
ROLL = Rolling(3)
MULTIPLIER = np.uint64(0xD1342543DE82EF95)


def class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"),
                        ("blank", " \t\n\v\f\r"), ("stop", ".,;:!?-"), ("quote", "'\"()[]{}"), ("symbol", SYMBOLS)):
        out[[ord(c) for c in chars]] = CLASSES.index(name)
    out[0xC3] = CLASSES.index("latin")
    for name, first, last in (("two", 0xC4, 0xE0), ("three", 0xE0, 0xF0), ("four", 0xF0, 0xF8)):
        out[first:last] = CLASSES.index(name)
    out[0xC2] = CLASSES.index("two")
    return out


CLASS_OF = class_table()


def codes_of(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return ROLL.of(ROLL.sums(np.frombuffer(b"".join(raw), np.uint8)), ends - [len(r) for r in raw], ends)


def per_text(where: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the places (ascending) lie in each text."""
    return np.diff(np.searchsorted(where, at))


def repeated(codes: np.ndarray, owner: np.ndarray, n: int = 8) -> np.ndarray:
    """Marks the words that lie in a window of n words which occurs twice or more in its text."""
    many = len(codes) - n + 1
    covered = np.zeros(len(codes) + 1, np.int32)
    if many > 0:
        up = np.multiply.accumulate(np.full(len(codes), MULTIPLIER, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up)])
        down = np.multiply.accumulate(np.full(many, pow(int(MULTIPLIER), -1, 1 << 64), np.uint64))
        start = np.flatnonzero(owner[:many] == owner[n - 1:])
        window = mix((sums[start + n] - sums[start]) * down[start])
        window = mix(window + owner[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
        twice = start[counts[which] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + n, -1)
    return np.cumsum(covered)[:-1] > 0


def measured(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text."""
    n = len(at) - 1
    start, end, first = word_bounds(data, at)
    owner = np.repeat(np.arange(n), np.diff(first))
    lead = (data & 0xC0) != 0x80
    shown = np.flatnonzero(lead & ~SPACE[data])
    codes = ROLL.of(ROLL.sums(data), start, end)
    again = repeated(codes, owner)
    # lines: the pieces between line breaks; those with a word
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([at[:-1], breaks + 1]))
    text = np.searchsorted(at, begin, side="right") - 1
    stop = np.append(begin[1:], len(data))
    inner = np.searchsorted(breaks, stop - 1)
    ends_in_break = (inner < len(breaks)) & (stop > begin)
    ends_in_break[ends_in_break] = breaks[inner[ends_in_break]] == stop[ends_in_break] - 1
    stop = stop - ends_in_break
    spoken = (np.searchsorted(start, stop) > np.searchsorted(start, begin)) & (text < n)
    begin, stop, text = begin[spoken], stop[spoken], text[spoken]
    lines = mix(ROLL.of(ROLL.sums(data), begin, stop) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    different = np.unique(lines, return_index=True)[1]
    doubled = np.bincount(text, minlength=n) - np.bincount(text[different], minlength=n)
    # common words: lower-cased, without a mark at the end
    low = LOWER[data]
    cut = end - np.isin(data[end - 1], np.frombuffer(b".,;:!?", np.uint8))
    known = codes_of(WORDS)
    order = np.argsort(known)
    lowered = ROLL.of(ROLL.sums(low), start, cut)
    spot = np.minimum(np.searchsorted(known[order], lowered), len(known) - 1)
    slot = np.where(known[order][spot] == lowered, order[spot], len(known))
    words = np.bincount(owner * (len(known) + 1) + slot, minlength=n * (len(known) + 1)).reshape(n, -1)
    leads = np.flatnonzero(lead)
    place = np.searchsorted(at, leads, side="right") - 1
    chars = np.bincount(place * len(CLASSES) + CLASS_OF[data[leads]], minlength=n * len(CLASSES)).reshape(n, -1)
    symbols = np.flatnonzero(np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8)))
    return {"n_words": np.diff(first), "word_chars": per_text(shown, at), "n_symbols": per_text(symbols, at),
            "n_dup_lines": doubled, "n_repeat_words": per_text(np.flatnonzero(again), first), "chars": chars, "words": words}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """The rows with a struct _quality_q of counts and histograms."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                m = measured(*utf8(part.column(text)))
                lists = {c: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.int64()))
                         for c, x in m.items() if x.ndim == 2}
                q = pa.StructArray.from_arrays([lists[c] if c in lists else pa.array(m[c], pa.int64()) for c in m], names=list(m))
                yield pa.RecordBatch.from_arrays([*part.columns, q], schema=pa.schema([*part.schema, pa.field("_quality_q", q.type)]))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    q = ", ".join([*(f"{c}: long" for c in COUNTS), "chars: array<long>", "words: array<long>"])
    return docs.mapInArrow(count, f"{kinds}, _quality_q struct<{q}>")


@dataclass(frozen=True)
class Limits:
    """chars, words: the largest divergence that passes, from 0 (alike) to 1 (nothing in common). A text
    without one common word is only at 0.14 to 0.15 by words, as all others share one slot. words is
    the limit with fewest errors, and of equals fewest good texts lost, on the labelled texts of sf0.1
    with even doc_id (README).
    min_chars, min_words: shorter texts are not judged by that histogram. min_reference: a language
    with fewer counts than this has no reference."""
    chars: float = 0.12
    words: float = 0.10
    min_chars: int = 200
    min_words: int = 50
    min_reference: int = 20_000


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two histograms of counts, to base 2; null if one is empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)
    share = lambda x, n: F.transform(x, lambda v: v / n)
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    terms = F.zip_with(share(p, total(p)), share(q, total(q)), lambda a, b: part(a, b) + part(b, a))
    out = F.aggregate(terms, F.lit(0.0), lambda s, v: s + v) / 2
    return F.when((total(p) > 0) & (total(q) > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), out)))


def summed(column: str, size: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.col(column)[i]), F.lit(0)) for i in range(size)])


def references(measured_: DataFrame, lang: str) -> DataFrame:
    """_quality_lang, _quality_chars, _quality_words: the histograms of each language, over all its texts."""
    return measured_.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("_quality_lang")).agg(
        summed("_quality_q.chars", len(CLASSES)).alias("_quality_chars"), summed("_quality_q.words", len(WORDS) + 1).alias("_quality_words"))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits(), carry: list[str] | None = None) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_js,
    word_js and kept; columns of these names are replaced.

    base_failed: fewer than 20 words, or over 30 % of the words in windows of 8 words that the text
    repeats. Else the histograms of the text, of character classes and of common words, are held
    against those of all texts of its language; the text goes if a Jensen-Shannon divergence, the
    square of the distance, is above its limit. A text below the minimum length, or with a null
    language or one of few texts, is not judged by that histogram. A null text has no words. Rows
    that repeat count each time.

    carry: the columns of docs to keep; all where it is not given.
    """
    rows = docs.drop(*COUNTS, "base_failed", "char_js", "word_js", "kept")
    names = rows.columns if carry is None else carry
    rows = rows.select(*names, F.col(lang).alias("_quality_language"), F.coalesce(F.col(text), F.lit("")).alias("_quality_t"))
    # measured once: the references need all texts before any of them can be judged
    counted = written(with_counts(rows, "_quality_t").drop("_quality_t"), "quality-counts")
    refs = written(references(counted, "_quality_language"), "quality-references")
    out = counted.join(refs, counted["_quality_language"] == refs["_quality_lang"], "left").withColumns({
        "_quality_cj": divergence(F.col("_quality_q.chars"), F.col("_quality_chars")), "_quality_wj": divergence(F.col("_quality_q.words"), F.col("_quality_words"))})
    size = lambda c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda s, v: s + v)
    q = F.col("_quality_q")
    failed = (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])
    far_chars = (size("_quality_q.chars") >= limits.min_chars) & (size("_quality_chars") >= limits.min_reference) & (F.col("_quality_cj") > limits.chars)
    far_words = (q["n_words"] >= limits.min_words) & (size("_quality_words") >= limits.min_reference) & (F.col("_quality_wj") > limits.words)
    far = F.coalesce(far_chars, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return out.select(*names, *[q[c].alias(c) for c in COUNTS], failed.alias("base_failed"), F.col("_quality_cj").alias("char_js"),
                      F.col("_quality_wj").alias("word_js"), (~failed & ~far).alias("kept"))
