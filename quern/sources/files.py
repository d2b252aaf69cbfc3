"""Readers for the file forms that company data comes in. Schemas are declared; nothing is inferred."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(spark: SparkSession, path: str, columns: list[str], *, sep: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """All columns as strings; rows that don't parse are dropped."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).options(sep=sep, encoding=encoding, header=header, mode="DROPMALFORMED").csv(path)


def json_rows(spark: SparkSession, path: str, schema: str, *, array: bool = False) -> DataFrame:
    """Newline-delimited objects, or one array a file."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def with_origin(df: DataFrame) -> DataFrame:
    """Adds the path, size and time of the file that each row comes from."""
    return df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_modification_time").alias("_time"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its text and origin. Compressed files are read by their extension."""
    return with_origin(spark.read.option("wholetext", True).text(path))


def xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """One row per element with the tag."""
    return spark.read.schema(schema).option("rowTag", tag).format("xml").load(path)


def members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """archive, member, content of every ZIP or gzip member whose name ends with the suffix; broken archives have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, name, body) for p, raw in zip(pdf["path"], pdf["content"], strict=True) for name, body in _unpacked(p, bytes(raw)) if name.endswith(suffix)]
            yield pd.DataFrame(rows, columns=["archive", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, content binary")


def _unpacked(path: str, raw: bytes) -> Iterator[tuple[str, bytes]]:
    try:
        if raw[:2] == b"\x1f\x8b":
            yield path.rsplit("/", 1)[-1].removesuffix(".gz"), gzip.decompress(raw)
        else:
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                for name in z.namelist():
                    if not name.endswith("/"):
                        yield name, z.read(name)
    except (OSError, EOFError, zipfile.BadZipFile):
        return


def warc_records(raw: bytes) -> Iterator[tuple[str, str, int, bytes]]:
    """(record type, URI, HTTP status, body) of each record of a WARC file, gzipped or not; a broken tail is left."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0 and (end := data.find(b"\r\n\r\n", start)) >= 0:
        fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in data[start:end].decode("utf-8", "replace").split("\r\n")[1:]))
        size = int(fields.get("content-length", "0") or 0)
        block = data[end + 4 : end + 4 + size]
        at = end + 4 + size
        head, _, body = block.partition(b"\r\n\r\n") if fields.get("warc-type") == "response" else (b"", b"", block)
        status = head.split(b" ", 2)[1:2]
        yield fields.get("warc-type", ""), fields.get("warc-target-uri", "").strip("<>"), int(status[0]) if status and status[0].isdigit() else 0, body


def warc(spark: SparkSession, path: str) -> DataFrame:
    """type, uri, status and body of the records of WARC files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([r for raw in pdf["content"] for r in warc_records(bytes(raw))], columns=["type", "uri", "status", "body"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "type string, uri string, status int, body binary")


_XBRLI = "{http://www.xbrl.org/2003/instance}"


def xbrl_facts(document: bytes) -> list[tuple[str, str, str, str, str, str, str]]:
    """(concept, context, entity, period start, period end, unit, value) of the facts of an XBRL instance; none for broken XML."""
    try:
        root = ElementTree.fromstring(document)
    except ElementTree.ParseError:
        return []
    contexts, units, out = {}, {}, []
    for c in root.iter(f"{_XBRLI}context"):
        find = lambda name, c=c: next((x.text.strip() for x in c.iter(f"{_XBRLI}{name}") if x.text), "")
        contexts[c.get("id")] = (find("identifier"), find("startDate") or find("instant"), find("endDate") or find("instant"))
    for u in root.iter(f"{_XBRLI}unit"):
        units[u.get("id")] = next((x.text.strip() for x in u.iter(f"{_XBRLI}measure") if x.text), "")
    for node in root:
        if node.get("contextRef"):
            concept = node.tag.rsplit("}", 1)[-1]
            out.append((concept, node.get("contextRef"), *contexts.get(node.get("contextRef"), ("", "", "")), units.get(node.get("unitRef"), ""), (node.text or "").strip()))
    return out


def xbrl(files: DataFrame, content: str = "content", key: str = "path") -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *f) for k, raw in zip(pdf[key], pdf[content], strict=True) for f in xbrl_facts(bytes(raw))]
            yield pd.DataFrame(rows, columns=[key, "concept", "context", "entity", "period_start", "period_end", "unit", "value"])

    return files.select(key, content).mapInPandas(run, f"`{key}` string, concept string, context string, entity string, period_start string, period_end string, unit string, value string")


def delegations(spark: SparkSession, path: str) -> DataFrame:
    """Address and number delegations of a registry's extended file: IPv4 ranges as first and last number."""
    fields = F.split("value", r"\|")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(fields.alias("f")).where((F.size("f") >= 7) & F.col("f")[2].isin("ipv4", "ipv6", "asn") & (F.col("f")[1] != "*"))
    from ..functions import net

    first = F.when(F.col("f")[2] == "ipv4", net.ipv4_number(F.col("f")[3]))
    return rows.select(F.col("f")[0].alias("registry"), F.col("f")[1].alias("country"), F.col("f")[2].alias("kind"), F.col("f")[3].alias("start"), F.col("f")[4].cast("bigint").alias("size"), F.try_to_date(F.col("f")[5], "yyyyMMdd").alias("day"), F.col("f")[6].alias("status"), first.alias("first"), (first + F.col("f")[4].cast("bigint") - 1).alias("last"))


def jdbc(spark: SparkSession, url: str, table: str, *, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A table of another database, read in parallel by (column, least, greatest, parts) if given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition:
        column, low, high, parts = partition
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()
