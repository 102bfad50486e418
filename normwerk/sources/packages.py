"""Packages of statutes and acts (XML or ZIP files) to XML texts, one row a file; nothing is trusted.

Refused: members outside of the package, encrypted members, too many or too large members, members that unpack to far more
than they hold, internal document type definitions and entities. A refused package is a row with an ``issue``.
"""

from __future__ import annotations

import hashlib
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_MEMBERS = 5_000
MOST_BYTES = 256 * 2**20
MOST_RATIO = 200
OPENED = "path string, sha256 string, member string, root string, xml string, assets array<struct<name:string,sha256:string,size:bigint>>, issue string"


class Refused(ValueError):
    """Why a package is not read."""


def preflight(data: bytes) -> None:
    """Refuse internal DTDs and entity declarations; an external DOCTYPE that declares nothing is inert."""
    if re.search(rb"<!ENTITY", data, re.I):
        raise Refused("entity_declaration")
    if re.search(rb"<!DOCTYPE[^>\[]*\[", data, re.I):
        raise Refused("internal_dtd")


_PROLOG = re.compile(rb"(?:\xef\xbb\xbf|\s+|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)*", re.S)


def root_of(data: bytes) -> str:
    """The name of the first element, however long what stands before it."""
    m = re.compile(rb"<([A-Za-z_][\w.\-]*)").match(data, _PROLOG.match(data).end())
    return m[1].decode() if m else ""


def members(data: bytes) -> dict[str, bytes]:
    """Files of a ZIP by name; a file that is no ZIP is one member without a name."""
    if not data.startswith(b"PK"):
        return {"": data}
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
        infos = [i for i in archive.infolist() if not i.is_dir()]
    except zipfile.BadZipFile as e:
        raise Refused("not_a_zip") from e
    if len(infos) > MOST_MEMBERS or sum(i.file_size for i in infos) > MOST_BYTES:
        raise Refused("too_large")
    out = {}
    for i in infos:
        if i.filename.startswith(("/", "\\")) or ".." in re.split(r"[/\\]", i.filename) or ":" in i.filename:
            raise Refused("unsafe_member")
        if i.flag_bits & 1:
            raise Refused("encrypted_member")
        if i.file_size > MOST_RATIO * max(1, i.compress_size) and i.file_size > 2**20:
            raise Refused("compression_ratio")
        out[i.filename] = archive.read(i)
    return out


def content(files: dict[str, bytes], named: str | None = None) -> tuple[str, bytes]:
    """The member that holds the act: the named one, else the largest XML that is no description (``.doc.xml``)."""
    if named in files:
        return named, files[named]
    xml = {k: v for k, v in files.items() if k == "" or (k.lower().endswith((".xml", ".fmx4")) and not k.lower().endswith(".doc.xml"))}
    if not xml:
        raise Refused("no_xml")
    return max(xml.items(), key=lambda kv: (len(kv[1]), kv[0]))


def _open(roots: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asset = pa.list_(pa.struct([("name", pa.string()), ("sha256", pa.string()), ("size", pa.int64())]))
        for batch in batches:
            rows = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                digest, name, root, text, assets, issue = hashlib.sha256(data).hexdigest(), None, None, None, [], None
                try:
                    files = members(data)
                    name, body = content(files)
                    preflight(body)
                    root = root_of(body)
                    if roots and root not in roots:
                        raise Refused("unexpected_root")
                    text = body.decode("utf-8-sig")
                    assets = [{"name": k, "sha256": hashlib.sha256(v).hexdigest(), "size": len(v)} for k, v in sorted(files.items()) if k != name]
                except Refused as e:
                    issue = str(e)
                except (UnicodeDecodeError, zipfile.BadZipFile, RuntimeError, NotImplementedError):
                    issue = "unreadable"
                rows.append((path, digest, name, root, text, assets, issue))
            types = [*[pa.string()] * 5, asset, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [x.split(" ")[0] for x in ("path", "sha256", "member", "root", "xml", "assets", "issue")])

    return run


def read_packages(spark: SparkSession, path: str, roots: tuple[str, ...] = ()) -> DataFrame:
    """Every file below ``path``, opened; columns as OPENED. ``roots`` are the root elements that are accepted (any, if none)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_open(frozenset(roots)), OPENED)


def issues(opened: DataFrame) -> DataFrame:
    return opened.where("issue is not null").select("path", "sha256", "issue")


def good(opened: DataFrame) -> DataFrame:
    return opened.where(F.col("issue").isNull())


def fault(data: bytes, kind: str) -> str | None:
    """What is wrong with the bytes of a file of a kind: pdf, zip, xml or xhtml; null if nothing is seen."""
    if not data:
        return "empty"
    if kind == "pdf":
        return None if data.startswith(b"%PDF-") and b"%%EOF" in data[-2048:] else "no_pdf"
    if kind == "zip":
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                return "damaged_member" if z.testzip() else None if z.namelist() else "empty_archive"
        except (zipfile.BadZipFile, RuntimeError, NotImplementedError):
            return "no_zip"
    try:
        preflight(data)
        root = ET.fromstring(data)
    except Refused as e:
        return str(e)
    except (ET.ParseError, ValueError):
        return "no_xml"
    return "no_html" if kind == "xhtml" and root.tag.rsplit("}", 1)[-1].lower() != "html" else None


def _faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fault(d, k) for d, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "fault"])


def file_faults(files: DataFrame) -> DataFrame:
    """files(path, content, kind) -> (path, fault) of the files with one."""
    return files.select("path", "content", "kind").mapInArrow(_faults, "path string, fault string").where("fault is not null")
