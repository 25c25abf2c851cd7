"""Readers: dimensions, N-Triples, search responses, zipped bodies, and a paged search as a data source."""

from __future__ import annotations

import io
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Namespaces by prefix.
PREFIXES = {
    "cdm": "http://publications.europa.eu/ontology/cdm#", "eli": "http://data.europa.eu/eli/ontology#", "owl": "http://www.w3.org/2002/07/owl#", "xsd": "http://www.w3.org/2001/XMLSchema#",
    "skos": "http://www.w3.org/2004/02/skos/core#", "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "dc": "http://purl.org/dc/elements/1.1/",
    "corp": "http://publications.europa.eu/resource/authority/corporate-body/", "res-type": "http://publications.europa.eu/resource/authority/resource-type/", "res-oj": "http://publications.europa.eu/resource/oj/",
    "res-celex": "http://publications.europa.eu/resource/celex/", "lang": "http://publications.europa.eu/resource/authority/language/", "ev": "http://eurovoc.europa.eu/",
    "m-app": "http://www.iana.org/assignments/media-types/application/", "euvoc": "http://publications.europa.eu/ontology/euvoc#",
}
_TRIPLE = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'


def dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; empty fields are null."""
    return spark.read.schema(schema).csv(path, header=True)


def shortened(iri: Column) -> Column:
    """Known namespaces as prefixes."""
    out = iri
    for prefix, full in PREFIXES.items():
        out = F.when(iri.startswith(full), F.concat(F.lit(f"{prefix}:"), F.substr(iri, F.lit(len(full) + 1)))).otherwise(out)
    return out


def n_triples(spark: SparkSession, path: str) -> DataFrame:
    """triples(s, p, o, o_kind, datatype, lang) from N-Triples lines; what is no statement goes."""
    lines = spark.read.text(path).where(F.col("value").rlike(_TRIPLE))
    part = lambda i: F.nullif(F.regexp_extract("value", _TRIPLE, i), F.lit(""))
    literal = F.regexp_replace(F.regexp_replace(F.regexp_extract("value", _TRIPLE, 6), r"\\\"", '"'), r"\\n", "\n")
    kind = F.when(part(4).isNotNull(), "iri").when(part(5).isNotNull(), "blank").otherwise("literal")
    return lines.select(
        F.coalesce(shortened(part(1)), part(2)).alias("s"), shortened(part(3)).alias("p"), F.coalesce(shortened(part(4)), part(5), literal).alias("o"), kind.alias("o_kind"), shortened(part(8)).alias("datatype"), part(7).alias("lang"),
    )


def search_query(kind: str, **parts: str) -> str:
    """Fixed query forms of the search service; multi takes up to 100 ids."""
    forms = {"wildcard": "DN = {celex}", "consolidated": "DTS_SUBDOM = CONSLEG AND DN = {celex}", "year": "DTS_SUBDOM = CONSLEG AND DD >= 01/01/{year} AND DD <= 31/12/{year}"}
    if kind == "multi":
        ids = parts["celexes"].split(",")
        if len(ids) > 100:
            raise ValueError("at most 100 ids in a query")
        return " OR ".join(f"DN = {i}" for i in ids)
    return forms[kind].format(**parts)


def search_hits(xml: str) -> list[dict]:
    """Hits of one response: celex, in_force, date, languages. A fault raises; hits without a known id are skipped."""
    root = ElementTree.fromstring(xml)
    name = lambda e: e.tag.rpartition("}")[2]
    if any(name(e) == "Fault" for e in root.iter()):
        raise RuntimeError(next((e.text for e in root.iter() if name(e) in ("Text", "faultstring")), "fault"))
    out: dict[str, dict] = {}
    for hit in (e for e in root.iter() if name(e) == "result"):
        values: dict[str, list[str]] = {}
        for e in hit.iter():
            if e.text and e.text.strip():
                values.setdefault(name(e), []).append(e.text.strip())
        celex = next((v for v in values.get("ID_CELEX", []) + values.get("VALUE", []) if re.fullmatch(r"[0-9]{5}[A-Z]{1,2}[0-9]{4}.*", v)), None)
        if celex is None:
            continue
        row = out.setdefault(celex, {"celex": celex, "in_force": {"true": True, "false": False}.get(next(iter(values.get("IN_FORCE", [])), "").lower()), "date": next(iter(values.get("DATE", [])), None), "languages": []})
        row["languages"] = sorted({*row["languages"], *values.get("LANG", [])})
    return list(out.values())


class RateLimiter:
    """Spaces calls of all processes that share a file: the next turn is taken under an exclusive lock."""

    def __init__(self, path: str, seconds: float = 1.0, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.path, self.seconds, self.clock, self.sleep = Path(path), seconds, clock, sleep

    def wait(self) -> None:
        import fcntl

        with self.path.open("a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            turn = max(self.clock(), float(f.read() or 0))
            f.truncate(0)
            f.write(str(turn + self.seconds))
        if (rest := turn - self.clock()) > 0:
            self.sleep(rest)


def retried(call: Callable, times: int = 3, pause: float = 5.0, errors: tuple = (OSError,), sleep: Callable[[float], None] = time.sleep):
    """Call until it succeeds, at most so many times."""
    for k in range(times):
        try:
            return call()
        except errors:
            if k == times - 1:
                raise
            sleep(pause)


class PagedSearch(DataSource):
    """spark.read.format("paged_search"): one partition for each page of a search.

    Options: pages, page_size (100 at most), and url, to which page and size are appended. Credentials
    are never part of the code: url carries what the service needs.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "celex string, in_force boolean, date string, languages array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.count, self.size = options["url"], int(options.get("pages", 1)), min(100, int(options.get("page_size", 100)))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(1, self.count + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from urllib.request import urlopen

        address = self.url.format(page=partition.value, size=self.size)
        body = retried(lambda: urlopen(address, timeout=30).read().decode())
        for h in search_hits(body):
            yield h["celex"], h["in_force"], h["date"], h["languages"]


def zipped_bodies(files: DataFrame, pattern: str = r"\.xml$") -> DataFrame:
    """(path, name, body) of the matching members of zip archives read as binaryFile; broken archives have one row with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        rows += [(path, n, z.read(n), None) for n in sorted(z.namelist()) if re.search(pattern, n)]
                except (zipfile.BadZipFile, OSError) as e:
                    rows.append((path, None, None, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.string(), pa.binary(), pa.string()))], names=["path", "name", "body", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, name string, body binary, error string")
