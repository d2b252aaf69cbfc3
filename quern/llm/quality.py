"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Per document, base counts are taken from the whole text. Each measure is a rate: hits by size. Its distribution per
(lang, source) is kept as a sketch of logarithmic buckets with GAMMA relative width: a table of bucket counts, exact to
add up in any order, whose quantiles have a relative error of at most (GAMMA - 1) / 2. The sketch alone sets the
threshold: the upper quartile plus SPREAD interquartile ranges; for a measure that most documents have none of, whose
quartiles are all 0, at least the sketch's mean (SPARSE) or the same fence over the logarithms of its non-zero part, with
BURST_SPREAD (BURSTS). A group with fewer than least_group documents, or non-zero ones for the latter, takes the sketch
merged over its language, and a small language the one over all. Documents are filtered by joining their group's
thresholds; one is rejected if its rate lies above the threshold by more than the chance in SIGMAS deviations of its hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize
from .text_arrays import Words, pieces, string_buffers

GAMMA = 1.05
SPREAD = 3.0
BURST_SPREAD = 1.5
SIGMAS = 3.0
#: Measure: its hits and its size among the base counts.
MEASURES = {
    "symbol": ("n_symbols", "n_words"),
    "dup_line": ("n_dup_lines", "n_lines"),
    "repeat": ("n_repeat_words", "n_words"),
    "mean_word": ("word_chars", "n_words"),
}
SPARSE, BURSTS = ("symbol",), ("dup_line", "repeat")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def _counts(column: pa.Array) -> list[np.ndarray]:
    data, offsets = string_buffers(column)
    rows = len(offsets) - 1
    words = Words(data, offsets, lower=False)
    per = lambda at, weights=None: np.bincount(at, weights, rows).astype(np.int64)
    n_words = np.diff(words.bounds)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = per(words.row, heads[words.end] - heads[words.start])
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    n_symbols = marks[offsets[1:]] - marks[offsets[:-1]]

    hashes, first = words.shingles(3)
    row = words.row[first]
    order = np.lexsort((hashes, row))
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    often = np.zeros(len(first), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    covered = np.zeros(len(words.hash), bool)
    for k in range(3):
        covered[first[often] + k] = True
    n_repeat = per(words.row[covered])

    n_lines, n_dup = _lines(data, offsets)
    return [n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat]


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier one, per row."""
    rows = len(offsets) - 1
    n_lines, n_dup = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    raw = data.tobytes()
    for k in range(rows):
        lines = [x for x in raw[offsets[k] : offsets[k + 1]].split(b"\n") if x.strip(b"\x20\x09\x0a\x0b\x0c\x0d")]
        n_lines[k] = len(lines)
        n_dup[k] = len(lines) - len(set(lines))
    return n_lines, n_dup


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep and the COUNTS of every row's whole __text; a null text has none of anything. Texts alone go to
    the Python workers, and counts alone come back."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in _counts(piece)], list(COUNTS))

    counted = F.arrow_udf(run, "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">").asNondeterministic()
    return docs.select(*keep, counted("__text").alias("__counts")).select(*keep, "__counts.*")


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bucket_of(value: str) -> str:
    """SQL: the sketch bucket of a value; zero has its own. Values are cut to millionths first, to be the same on every machine."""
    return f"case when {value} > 0 then cast(floor(ln(greatest({value}, 0.000001)) / ln({GAMMA}) + 1000) as int) else -1 end"


def sketches(counts: DataFrame, groups: list[str]) -> DataFrame:
    """groups, measure, bucket, n: the sketches of documents that passed the base rules."""
    measured = counts.where(~base_failed()).select(*groups, F.expr("stack(%d, %s) as (measure, value)" % (len(MEASURES), ", ".join(f"'{m}', {hits} / cast({size} as double)" for m, (hits, size) in MEASURES.items()))))
    return measured.groupBy(*groups, "measure", F.expr(bucket_of("value")).alias("bucket")).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and measure: documents, fence, non-zero documents and the fence of the non-zero part. One row per group,
    measure and bucket comes in, of which there are at most about 600 a group and measure, whatever the number of documents."""
    by = [*groups, "measure"]
    w = Window.partitionBy(*by)
    some = F.when(F.col("bucket") >= 0, F.col("n")).otherwise(0)
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.select(*by, "bucket", "n", F.sum("n").over(w).alias("total"), F.sum("n").over(upto).alias("upto"), F.sum(some).over(w).alias("some"), F.sum(some).over(upto).alias("some_upto"))
    value = F.expr(f"case when bucket < 0 then 0D else pow(cast({GAMMA} as double), bucket - 1000 + 0.5) end")
    whole = {name: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), value)).alias(name) for name, share in (("q1", 0.25), ("q3", 0.75))}
    part = {name: F.min(F.when((F.col("bucket") >= 0) & (F.col("some_upto") >= F.ceil(F.col("some") * share)), F.col("bucket"))).alias(name) for name, share in (("p1", 0.25), ("p3", 0.75))}
    found = ranked.groupBy(*by).agg(F.max("total").alias("docs"), F.max("some").alias("some"), (F.sum(F.col("n") * value) / F.sum("n")).alias("mean"), *whole.values(), *part.values())
    fence = F.col("q3") + SPREAD * (F.col("q3") - F.col("q1"))
    burst = F.expr(f"pow(cast({GAMMA} as double), p3 + {BURST_SPREAD} * (p3 - p1) - 1000 + 0.5)")
    return found.select(*by, "docs", F.when(F.col("measure").isin(*SPARSE), F.greatest(fence, "mean")).otherwise(fence).alias("fence"), "some", F.when(F.col("measure").isin(*BURSTS), burst).alias("burst"))


def thresholds(counts: DataFrame, least_group: int) -> DataFrame:
    """__lang, __source, and a column of thresholds for each measure; one row for each pair that has documents left."""
    fine = sketches(counts, ["__lang", "__source"])
    merged = {
        "by_source": (fine, ["__lang", "__source"]),
        "by_lang": (fine.groupBy("__lang", "measure", "bucket").agg(F.sum("n").alias("n")), ["__lang"]),
        "by_all": (fine.groupBy("measure", "bucket").agg(F.sum("n").alias("n")), []),
    }
    out = None
    for name, (sketch, groups) in merged.items():
        fences = _fences(sketch, groups).withColumnsRenamed({c: f"{c}_{name}" for c in ("docs", "fence", "some", "burst")})
        if out is None:
            out = fences
        else:
            right = fences.withColumnsRenamed({g: f"r_{g}" for g in [*groups, "measure"]})
            on = [F.col(g).eqNullSafe(F.col(f"r_{g}")) for g in [*groups, "measure"]]
            out = out.join(right, on, "left").drop(*[f"r_{g}" for g in [*groups, "measure"]])
    level = lambda what, size: F.when(F.col(f"{size}_by_source") >= least_group, F.col(f"{what}_by_source")).when(F.col(f"{size}_by_lang") >= least_group, F.col(f"{what}_by_lang")).otherwise(F.col(f"{what}_by_all"))
    limit = F.greatest(level("fence", "docs"), level("burst", "some"))
    return out.groupBy("__lang", "__source").agg(*[F.max(F.when(F.col("measure") == m, limit)).alias(f"most_{m}") for m in MEASURES])


def quality_filter(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_group: int = 100, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, keep, base counts, base_failed and kept, one row per row of docs.

    A null text has no words and fails the base rules. Null languages or sources form groups of their own. kept is
    false where base_failed, or where a measure exceeds the group's threshold. Repeated rows return each. An empty
    table gives an empty result; other columns are ignored, whatever their names."""
    picked = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"), F.col(text_col).alias("__text"), *keep)
    counts = materialize(base_counts(picked, ["__id", "__lang", "__source", *keep]))
    limits = thresholds(counts, least_group).withColumnsRenamed({"__lang": "g_lang", "__source": "g_source"})
    joined = counts.join(limits, F.col("__lang").eqNullSafe(F.col("g_lang")) & F.col("__source").eqNullSafe(F.col("g_source")), "left")
    fits = F.lit(True)
    for m, (hits, size) in MEASURES.items():
        fits = fits & (F.expr(f"({hits} - {SIGMAS}D * sqrt({hits})) / nullif({size}, 0)") <= F.col(f"most_{m}"))
    failed = base_failed()
    return joined.select(F.col("__id").alias(id_col), *keep, *COUNTS, failed.alias("base_failed"), F.when(failed, False).otherwise(F.coalesce(fits, F.lit(True))).alias("kept"))
