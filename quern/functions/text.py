"""Text keys, identifiers and similarities as column expressions; Arrow-batched Python only where Spark has no function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def squash_key(text: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def city_key(text: Column) -> Column:
    return F.upper(F.trim(F.coalesce(text, F.lit(""))))


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]", "")


@pandas_udf(T.StringType())
def fold_accents(texts: pd.Series) -> pd.Series:
    """NFKD without combining marks, case-folded."""
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold())


def _osa(a: str, b: str) -> int:
    """Least edits with transpositions of neighbours, no substring edited twice."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows = [rows[-1], row]
    return rows[-1][-1]


@pandas_udf(T.LongType())
def damerau_levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _osa(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")


def shingles(text: Column, n: int) -> Column:
    """Distinct character n-grams."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda k: F.substring(text, k, F.lit(n))))


def ngram_distance(a: Column, b: Column, n: int = 3) -> Column:
    """1 - Jaccard similarity of character n-grams."""
    x, y = shingles(a, n), shingles(b, n)
    common = F.size(F.array_intersect(x, y))
    return 1 - common / (F.size(x) + F.size(y) - common)


def name_similarity(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def mod_97(token: Column) -> Column:
    """Remainder of ISO 7064 MOD 97-10, letters counting from 10; -1 for other characters."""
    code = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(F.lit(-1000))
    step = lambda rem, c: F.when((rem < 0) | (code(c) < 0), F.lit(-1)).when(code(c) < 10, (rem * 10 + code(c)) % 97).otherwise((rem * 100 + code(c)) % 97)
    return F.aggregate(F.filter(F.split(token, ""), lambda c: c != ""), F.lit(0), step)


def valid_lei(token: Column) -> Column:
    return (F.length(token) == 20) & (mod_97(token) == 1)


def valid_de_vat(number: Column) -> Column:
    """ISO 7064 MOD 11,10 over nine digits."""
    def step(product: Column, c: Column) -> Column:
        s = (c.cast("int") + product) % 10
        return (F.when(s == 0, 10).otherwise(s) * 2) % 11

    check = 11 - F.aggregate(F.split(F.left(number, F.lit(8)), ""), F.lit(10), step)
    return number.rlike("^[0-9]{9}$") & (F.when(check == 10, 0).otherwise(check) == F.right(number, F.lit(1)).cast("int"))


def luhn(number: Column) -> Column:
    """Every second digit from the right doubled; the digits' sum must be a multiple of 10."""
    doubled = F.transform(F.split(F.reverse(number), ""), lambda c, k: F.when(k % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))
    return number.rlike("^[0-9]+$") & (F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0)


# VAT number formats of the European Union's countries and some neighbours, without the country code.
VAT_FORMATS = {
    "AT": r"U\d{8}", "BE": r"[01]\d{9}", "BG": r"\d{9,10}", "CY": r"\d{8}[A-Z]", "CZ": r"\d{8,10}", "DE": r"\d{9}", "DK": r"\d{8}",
    "EE": r"\d{9}", "EL": r"\d{9}", "ES": r"[A-Z0-9]\d{7}[A-Z0-9]", "FI": r"\d{8}", "FR": r"[A-Z0-9]{2}\d{9}", "GB": r"(?:\d{9}|\d{12}|(?:GD|HA)\d{3})",
    "HR": r"\d{11}", "HU": r"\d{8}", "IE": r"(?:\d{7}[A-W]|[7-9][A-Z*+]\d{5}[A-W]|\d{7}[A-W][AH])", "IT": r"\d{11}", "LT": r"(?:\d{9}|\d{12})", "LU": r"\d{8}",
    "LV": r"\d{11}", "MT": r"\d{8}", "NL": r"\d{9}B\d{2}", "PL": r"\d{10}", "PT": r"\d{9}", "RO": r"\d{2,10}", "SE": r"\d{12}", "SI": r"\d{8}", "SK": r"\d{10}",
}


def valid_vat(token: Column) -> Column:
    """Country format for all, check digits for Germany and Italy."""
    t = F.upper(F.regexp_replace(token, " ", ""))
    number = F.substring(t, 3, 100)
    shape = t.rlike("^(?:" + "|".join(f"{c}{p}" for c, p in VAT_FORMATS.items()) + ")$")
    return shape & F.when(t.startswith("DE"), valid_de_vat(number)).when(t.startswith("IT"), luhn(number)).otherwise(F.lit(True))


def version_rank(version: Column) -> Column:
    """Greatest for the best version: more numeric parts, then the higher parts; the text itself, the lesser the better, must break ties."""
    parts = F.transform(F.filter(F.split(version, r"\."), lambda p: p != ""), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))
    return F.struct(F.size(parts).alias("n"), parts.alias("parts"))


def rounded_months(start: Column, end: Column) -> Column:
    """Months between two dates, both included, by the mean month."""
    return F.round((F.datediff(end, start) + 1) / F.lit(30.4375)).cast("bigint")


def md5_number(text: Column) -> Column:
    """A row identity: the first 15 hexadecimal digits of MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


# Name parts that carry no identity.
_TITLES = frozenset("dr prof professor ing dipl med phd mr mrs ms herr frau".split())
_PARTICLES = frozenset("von van de der den af av la le du da di".split())


@pandas_udf(T.ArrayType(T.StringType()))
def person_tokens(names: pd.Series) -> pd.Series:
    """Folded name parts in order, without titles, particles and punctuation."""
    def tokens(name: str | None) -> list[str]:
        plain = "".join(c if c.isalpha() or c in "- " else " " for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c)).casefold()
        return sorted({p for p in plain.replace("-", " ").split() if p not in _TITLES and p not in _PARTICLES})

    return names.map(tokens)
