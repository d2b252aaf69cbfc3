"""Canonical exact digests of whole texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize, shuffle_width

_ICU = "com.ibm.icu"


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again; runs of white space become one space and the ends are trimmed. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    compose = lambda c: F.reflect(F.lit(f"{_ICU}.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = compose(F.reflect(F.lit(f"{_ICU}.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True)))
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(text.rlike(r"\A[\x00-\x7F]*\z"), plain).otherwise(F.trim(F.regexp_replace(folded, r"[\s\p{Z}\x{85}]+", " ")))


def digest(canon: Column) -> Column:
    """128 bits of xxhash64 under two seeds, as 32 hexadecimal digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(canon), F.xxhash64(F.lit("second"), canon, F.lit(0x9E3779B9)))]))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, next, f, fs, x, xs: each row's text and that of the row after it in descending doc_id, the first row's
    after the last; the digest and SHA-256 of the canonical text of either.

    Rows are dealt into ranges of doc_id; each range also gets a copy of the next range's first row, so that no task
    orders the whole table. Equal ids are ordered by text; null ids come last."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    width = 2 * shuffle_width(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("doc_id", [k / width for k in range(1, width)], 100 * width)).first()[0] or []
    cuts = sorted(set(cuts))
    # part 0 has the highest ids; a null id goes to the last part
    last = len(cuts)

    def part(low: int, high: int) -> Column:
        """The last part less the number of cuts at or below doc_id, which lies in low..high, by halving."""
        if low == high:
            return F.lit(last - low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") >= cuts[middle], part(middle + 1, high)).otherwise(part(low, middle))

    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(part(0, last)).cast("int"))
    tops = {r["part"]: r["top"] for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}  # a row for each part
    parts = sorted(tops)
    if not parts:
        return rows.select("doc_id", "text", *[F.lit("").alias(c) for c in ("next", "f", "fs", "x", "xs")])
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    heads = docs.sparkSession.createDataFrame([(tops[p], parts[k - 1]) for k, p in enumerate(parts)], "top bigint, into int")
    found = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("into").agg(F.max("text").alias("text"))
    tails = found.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("into").alias("part"), F.lit(1).alias("tail"))
    both = rows.withColumn("tail", F.lit(0)).unionByName(tails).withColumn("canon", canonical(F.col("text")))
    both = both.select("doc_id", "text", "part", "tail", digest(F.col("canon")).alias("f"), F.sha2("canon", 256).alias("fs"))
    window = Window.partitionBy("part").orderBy(F.col("tail"), *order)
    ahead = [F.lead(c).over(window).alias(to) for c, to in (("text", "next"), ("f", "x"), ("fs", "xs"))]
    return both.select("doc_id", "text", "tail", "f", "fs", *ahead).where("tail = 0").drop("tail")


def edited(text: Column, after: Column) -> Column:
    """The last floor(n/2) code points of text replaced by the first as many (or all) of after."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(after, half))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one row per row of docs.

    The fingerprint is an exact digest of the canonical text, so likeness is 1 where two are equal and else 0. Rows are
    grouped by digest and a group's canonical texts compared by their bytes; edited texts, which are kept nowhere, meet them
    and each other by SHA-256. Where a group differs, the digests in it are extended by the SHA-256, so that equal
    fingerprints always mean equal canonical texts. Null texts count as empty. Repeated rows return each; their
    order among equal ids is by text. An empty table gives an empty result; other columns are ignored."""
    rows = with_next(docs, id_col, text_col)
    canon = rows.withColumn("edited", edited(F.col("text"), F.col("next"))).withColumn("canon", canonical(F.col("edited")))
    table = materialize(canon.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "f", digest(F.col("canon")).alias("e"), "x", "fs", F.sha2("canon", 256).alias("es"), "xs"), drop_shuffles=True)
    both = table.select("f", "fs").unionByName(table.select(F.col("e").alias("f"), F.col("es").alias("fs")))
    met = both.groupBy("f").agg(F.min("fs").alias("lo"), F.max("fs").alias("hi")).where("lo <> hi").select("f")
    clashes = materialize(differing(docs.select(canonical(F.col(text_col)).alias("canon"))).unionByName(met).distinct(), drop_shuffles=True)
    return _named(table, None if clashes.isEmpty() else clashes.select(F.col("f").alias("bad")))


def differing(canon: DataFrame) -> DataFrame:
    """f: digests under which canonical texts of different bytes stand. A group meets as its least and greatest text,
    one row for each task that read some of it."""
    grouped = canon.groupBy(digest(F.col("canon")).alias("f")).agg(F.min("canon").alias("lo"), F.max("canon").alias("hi"))
    return grouped.where("lo <> hi").select("f")


def _named(table: DataFrame, clashes: DataFrame | None) -> DataFrame:
    names = {}
    for short, full in (("f", "fs"), ("e", "es"), ("x", "xs")):
        if clashes is None:
            names[short] = F.col(short)
        else:
            table = table.join(clashes.withColumnRenamed("bad", f"bad_{short}"), F.col(short) == F.col(f"bad_{short}"), "left")
            names[short] = F.when(F.col(f"bad_{short}").isNull(), F.col(short)).otherwise(F.concat(F.col(short), F.col(full)))
    same = lambda a, b: (names[a] == names[b]).cast("double")
    return table.select("doc_id", "n_chars", "edited_sha256", names["f"].alias("fingerprint"), names["e"].alias("edited_fingerprint"), same("f", "e").alias("near_edited"), same("f", "x").alias("near_next"))
