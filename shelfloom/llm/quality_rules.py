"""Quality rules with adaptive thresholds: a quantile sketch per language and source.

Each text is measured once. The ratios go into sketches that count values in bins of equal
relative width (``WIDTH``); such sketches are merged by adding counts, so they are ordinary
aggregations with partial results, and the same in every run. From the median and the upper
quantile of its group's sketch each ratio gets an upper fence. The quantiles of a language
are drawn towards those of all rows and those of a source towards its language's, with the
weight of ``SHRINK_ROWS`` rows, so no fence jumps at a row count. A group's fence is at most
its parent's, so a source full of junk does not raise its own. The fences are joined to the
rows, and a row above any of them is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, gram_hashes, texts_of, word_hashes
from shelfloom.sources.scratch import materialize

WIDTH, SHRINK_ROWS = 1.02, 200
UPPER = 0.9
#: A fence is upper + SPREAD * (upper - median), at least the median and the ratio's least distance.
SPREAD = 3.0
#: Ratio: its counts, the least distance, and whether it is a share, of at most 1 in any language.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 0.05, True),
    "dup_lines": ("n_dup_lines", "n_lines", 0.2, True),
    "repeats": ("n_repeat_words", "n_words", 0.15, True),
    "word_length": ("word_chars", "n_words", 2.0, False),
}

_BLANKS = b" \t\n\r\x0b\x0c"
_NO_CHARS = _BLANKS + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: np.ndarray, window: int = 3) -> int:
    """Words in windows of ``window`` words that the text has twice or more."""
    grams = gram_hashes(words, window)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    inside = np.zeros(len(words) + window, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + window, -1)
    return int((np.cumsum(inside)[: len(words)] > 0).sum())


def _measure():
    def cells(batch: pa.RecordBatch) -> list:
        out: list[list[int]] = [[], [], [], [], [], []]
        for text in texts_of(batch, "_text"):
            text = text or b""
            words = text.split()
            lines = [line for line in text.split(b"\n") if line.strip(_BLANKS)]
            values = (
                len(words), len(text.translate(None, _NO_CHARS)), len(text) - len(text.translate(None, _SYMBOLS)),
                len(lines), len(lines) - len(set(lines)), repeated_words(word_hashes(words)),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
        return out

    return cells


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the six counts of every row."""
    base = docs.select("doc_id", "lang", "source", F.col("text").cast("binary").alias("_text"))
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return add_columns(base, _measure, ", ".join(f"{n} bigint" for n in names), keep=["doc_id", "lang", "source"])


def fences(rows: DataFrame) -> DataFrame:
    """(lang, source, ratio, fence) for every group of rows with words."""
    value = F.explode(F.create_map(*[x for name, (a, b, *_) in RATIOS.items() for x in (F.lit(name), F.col(a) / F.col(b))]))
    long = rows.filter("n_words > 0").select("lang", "source", value.alias("ratio", "value"))
    bin_of = F.when(F.col("value") > 0, F.floor(F.log("value") / F.log(F.lit(WIDTH))))
    sketch = materialize(long.groupBy("lang", "source", "ratio", bin_of.alias("bin")).agg(F.count("*").alias("n")), "sketch")

    def quantiles(level: list[str], name: str) -> DataFrame:
        merged = sketch.groupBy(*level, "ratio", "bin").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*level, "ratio")
        # NULL is the bin of zeros and sorts first.
        to = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        at = F.coalesce(F.pow(F.lit(WIDTH), F.col("bin") + 0.5), F.lit(0.0))
        placed = merged.withColumns({"to": to, "all": F.sum("n").over(group), "at": at})
        found = placed.groupBy(*level, "ratio").agg(
            F.max("all").alias(f"rows_{name}"),
            F.min(F.when(F.col("to") >= 0.5 * F.col("all"), F.col("at"))).alias(f"mid_{name}"),
            F.min(F.when(F.col("to") >= UPPER * F.col("all"), F.col("at"))).alias(f"upper_{name}"),
        )
        return found.withColumnsRenamed({c: f"{c}_{name}" for c in (*level, "ratio")})

    def shrunk(value: str, level: str, parent: Column) -> Column:
        rows = F.col(f"rows_{level}")
        return (rows * F.col(f"{value}_{level}") + SHRINK_ROWS * parent) / (rows + SHRINK_ROWS)

    def of_ratio(place: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for n, values in RATIOS.items() for x in (n, values[place])]), F.col("ratio_own"))

    def fence(mid: Column, upper: Column) -> Column:
        free = F.greatest(upper + SPREAD * (upper - mid), mid + of_ratio(2))
        # No text has a share above 1: midway between the median and 1 is still in reach.
        return F.when(of_ratio(3), F.least(free, (1 + mid) / 2)).otherwise(free)

    own, by_lang, every = quantiles(["lang", "source"], "own"), quantiles(["lang"], "lang"), quantiles([], "all")
    joined = own.join(by_lang, F.col("lang_own").eqNullSafe(F.col("lang_lang")) & (F.col("ratio_own") == F.col("ratio_lang"))).join(
        every, F.col("ratio_own") == F.col("ratio_all")
    )
    of_all = fence(F.col("mid_all"), F.col("upper_all"))
    mid, upper = (shrunk(v, "lang", F.col(f"{v}_all")) for v in ("mid", "upper"))
    # Words of some languages are long, or have no blanks between them: only shares are bound by all rows.
    of_lang = F.when(of_ratio(3), F.least(fence(mid, upper), of_all)).otherwise(fence(mid, upper))
    of_own = F.least(fence(shrunk("mid", "own", mid), shrunk("upper", "own", upper)), of_lang)
    return joined.select(
        F.col("lang_own").alias("lang"), F.col("source_own").alias("source"), F.col("ratio_own").alias("ratio"), of_own.alias("fence")
    )


def judged(docs: DataFrame, least_words: int = 50, most_repeats: int = 50) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, above, kept.

    base_failed: fewer than ``least_words`` words, or more than ``most_repeats`` of a hundred
    words in repeated windows. ``above`` lists the ratios above their fences. kept: neither.
    NULL and empty texts have no words and fail. NULL languages and sources form groups of
    their own. Equal rows get equal results, each its own row; an empty table gives none.
    Other columns are not read.
    """
    rows = materialize(measured(docs), "measured")
    # One row per language and source, written down so that Spark knows its size at the join.
    limits = fences(rows).groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("ratio", "fence"))).alias("fences"))
    limits = materialize(limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fences"), "fences")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    above = F.array_compact(
        F.array(*[F.when(F.col(a) / F.nullif(F.col(b), F.lit(0)) > F.col("fences")[name], F.lit(name)) for name, (a, b, *_) in RATIOS.items()])
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        above.alias("above"), (~failed & (F.size(above) == 0)).alias("kept"),
    )
