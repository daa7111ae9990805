"""File sources: inventories with hashes and media types, archive members, and tables in several formats."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import stat
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Leading bytes of binary formats.
MAGIC = {"255044462d": "application/pdf", "89504e470d0a1a0a": "image/png", "ffd8ff": "image/jpeg", "474946383": "image/gif", "49492a00": "image/tiff", "4d4d002a": "image/tiff", "1f8b": "application/gzip", "504b0304": "application/zip", "d0cf11e0a1b11ae1": "application/msword"}
#: Suffixes of office documents inside a ZIP.
OFFICE = {"docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation", "ods": "application/vnd.oasis.opendocument.spreadsheet", "odt": "application/vnd.oasis.opendocument.text"}
QUARANTINED = ("application/octet-stream", "application/x-msdownload", "application/x-executable")


def walk(root: str, depth: int = 64, only: str | None = None) -> Iterator[tuple[str, str, int]]:
    """(relative path, status, size) of every entry under root, or of its entry `only`, by lstat alone: links are reported, never
    followed."""
    stack = [("", 0)]
    while stack:
        at, level = stack.pop()
        try:
            entries = sorted((e for e in os.scandir(os.path.join(root, at)) if at or only is None or e.name == only), key=lambda e: e.name, reverse=True)
        except OSError:
            yield at, "unreadable-directory", 0
            continue
        for e in entries:
            path = os.path.join(at, e.name)
            try:
                s = e.stat(follow_symlinks=False)
            except OSError:
                yield path, "unreadable", 0
                continue
            if stat.S_ISLNK(s.st_mode):
                yield path, "link", 0
            elif stat.S_ISDIR(s.st_mode):
                if level + 1 >= depth:
                    yield path, "directory-depth-limit", 0
                else:
                    stack.append((path, level + 1))
            elif stat.S_ISREG(s.st_mode):
                yield path, "file", s.st_size
            else:
                yield path, "unsupported-special", 0


def walk_frame(spark: SparkSession, root: str, silo: str, depth: int = 64) -> DataFrame:
    """The statuses of walk as rows (silo, relative_path, status, size).

    The driver lists the root alone; its folders are walked by the executors, which must see the same file system."""
    tops = [(os.path.basename(e), e) for e in sorted(x.path for x in os.scandir(root))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name in pdf["name"]:
                rows = [(silo, p, st, n) for p, st, n in walk(root, depth, name)]
                for lo in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[lo : lo + 10_000], columns=["silo", "relative_path", "status", "size"])

    names = spark.createDataFrame([(n,) for n, _ in tops], "name string").repartition(max(1, min(len(tops), 200)))
    return names.mapInPandas(run, "silo string, relative_path string, status string, size long")


def scan(spark: SparkSession, root: str, silo: str) -> DataFrame:
    """(silo, relative_path, size, modified, content_hash, media_type, encrypted, quarantine_reason) of every file, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = "file:" + os.path.abspath(root).rstrip("/") + "/"
    path = F.regexp_replace(F.regexp_replace("path", "^file:/*", "file:/"), "^" + re.escape(prefix), "")
    mime = media_type(F.col("content"), path)
    encrypted = F.position(F.lit("/Encrypt"), F.decode(F.col("content"), "ISO-8859-1")) > 0
    encrypted = (mime == "application/pdf") & encrypted
    return files.select(F.lit(silo).alias("silo"), path.alias("relative_path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("content_hash"), mime.alias("media_type"), encrypted.alias("encrypted"), quarantine_reason(mime, encrypted).alias("quarantine_reason"))


def media_type(content: Column, path: Column) -> Column:
    """Media type by leading bytes, office suffix, tar mark, byte-order marks, else text or octet-stream by its bytes."""
    head = F.lower(F.hex(F.substring(content, 1, 16)))
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    out = F.when(head.startswith("504b0304"), F.coalesce(F.create_map(*[F.lit(x) for kv in OFFICE.items() for x in kv])[suffix], F.lit("application/zip")))
    for magic, mime in MAGIC.items():
        if magic != "504b0304":
            out = out.when(head.startswith(magic), mime)
    out = out.when(F.substring(content, 258, 5) == F.lit(b"ustar"), "application/x-tar")
    for mark in ("0000feff", "fffe0000", "efbbbf", "feff", "fffe"):
        out = out.when(head.startswith(mark), "text/plain")
    sample = F.decode(F.substring(content, 1, 65536), "ISO-8859-1")
    return out.when(sample.rlike(r"[\x00-\x08\x0e-\x1f]"), "application/octet-stream").when(suffix.isin("html", "htm"), "text/html").otherwise("text/plain")


def quarantine_reason(mime: Column, encrypted: Column) -> Column:
    """Why a file is kept out of processing, null if it isn't."""
    return F.when(encrypted, "encrypted").when(mime.isin(*QUARANTINED), "unsupported-type")


def charset_of(raw: bytes) -> str | None:
    """Charset of text bytes: by mark, strict UTF-8, else the likelier of the two Cyrillic code pages; None for binary data."""
    for mark, name in ((b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xff\xfe\x00\x00", "utf-32-le"), (b"\xef\xbb\xbf", "utf-8-sig"), (b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le")):
        if raw.startswith(mark):
            return name
    if re.search(rb"[\x00-\x08\x0e-\x1f]", raw):
        return None
    try:
        raw.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        small = {e: sum("а" <= c <= "я" for c in raw.decode(e, "replace")) for e in ("cp1251", "koi8_r")}
        return max(small, key=lambda e: (small[e], e))


@dataclass(frozen=True)
class ArchivePolicy:
    """Limits of archive expansion."""

    nesting: int = 3
    members: int = 10_000
    member_bytes: int = 64 << 20
    total_bytes: int = 256 << 20
    ratio: int = 100


def members(raw: bytes, policy: ArchivePolicy = ArchivePolicy(), parent: str = "[]", level: int = 1, budget: list[int] | None = None) -> Iterator[tuple[str, str, int, str | None, str | None]]:
    """(address, name, size, content_hash, refusal) of every archive member; addresses are JSON lists of [index, name] per level."""
    budget = [0, 0] if budget is None else budget

    def address(index: int | str, name: str) -> str:
        return json.dumps([*json.loads(parent), [index, name]])

    try:
        if raw[:4] == b"PK\x03\x04":
            archive = zipfile.ZipFile(io.BytesIO(raw))
            entries = [(i.filename, i.file_size, i.compress_size, i.is_dir(), bool(i.flag_bits & 1), False, lambda i=i: archive.read(i)) for i in archive.infolist()]
        else:
            tar = tarfile.open(fileobj=io.BytesIO(raw), mode="r:*")
            entries = [(i.name, i.size, i.size, i.isdir(), False, i.issym() or i.islnk(), lambda i=i: tar.extractfile(i).read()) for i in tar]
    except (zipfile.BadZipFile, tarfile.TarError, EOFError, OSError):
        yield address("!policy", "unreadable"), "", 0, None, "unreadable-archive"
        return
    for index, (name, size, packed, folder, locked, link, read) in enumerate(entries):
        if folder:
            continue
        budget[0] += 1
        if budget[0] > policy.members:
            yield address("!policy", "member-limit"), name, size, None, "member-limit"
            return
        reason = (
            "encrypted" if locked else "unsafe-path" if name.startswith("/") or ".." in name.split("/") else "link" if link else "member-size" if size > policy.member_bytes
            else "ratio" if packed and size / packed > policy.ratio else "total-size" if budget[1] + size > policy.total_bytes else None
        )
        if reason:
            yield address(index, name), name, size, None, reason
            continue
        try:
            body = read()
        except (RuntimeError, NotImplementedError, zipfile.BadZipFile, OSError):
            yield address(index, name), name, size, None, "unsupported-compression"
            continue
        budget[1] += len(body)
        yield address(index, name), name, len(body), hashlib.sha256(body).hexdigest(), None
        if body[:4] == b"PK\x03\x04" or body[:2] == b"\x1f\x8b" or body[257:262] == b"ustar":
            if level >= policy.nesting:
                yield json.dumps([*json.loads(address(index, name)), ["!policy", "nesting"]]), name, 0, None, "nesting"
            else:
                yield from members(body, policy, address(index, name), level + 1, budget)


def explode_archives(files: DataFrame, policy: ArchivePolicy = ArchivePolicy()) -> DataFrame:
    """Member rows of binary rows (relative_path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["relative_path"], pdf["content"]):
                yield pd.DataFrame([(path, *m) for m in members(bytes(content), policy)], columns=["relative_path", "member", "name", "size", "content_hash", "refusal"])

    return files.select("relative_path", "content").mapInPandas(run, "relative_path string, member string, name string, size long, content_hash string, refusal string")


def inventory_counts(df: DataFrame, silo: str = "silo", size: str = "size", key: str = "content_hash", quarantined: Column | None = None) -> DataFrame:
    """(silo, files, bytes, quarantined, duplicates) per silo and in total (silo null), in one rollup."""
    q = F.lit(False) if quarantined is None else quarantined
    return df.rollup(silo).agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count_if(q).alias("quarantined"), (F.count(key) - F.count_distinct(key)).alias("duplicates"))


def read_table(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """A table by its suffix: Parquet, ORC, JSON array or lines, CSV, Arrow IPC; any other is refused, as is one of more than max_rows."""
    df = _read_table(spark, path)
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"{path} has more than {max_rows} rows")
    return df


def _read_table(spark: SparkSession, path: str) -> DataFrame:
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix in ("parquet", "orc"):
        return spark.read.format(suffix).load(path)
    if suffix == "json":
        return spark.read.option("multiLine", "true").json(path)
    if suffix in ("jsonl", "ndjson"):
        return spark.read.json(path)
    if suffix == "csv":
        return spark.read.option("header", "true").csv(path)
    if suffix in ("arrow", "ipc", "feather"):
        import pyarrow.ipc

        with pyarrow.ipc.open_file(path) as f:  # record batches are read by the tasks, one after another
            schema, n = f.schema, f.num_record_batches
        from pyspark.sql.pandas.types import from_arrow_schema

        def run(batches):
            for pdf in batches:
                with pyarrow.ipc.open_file(path) as g:
                    for k in pdf["id"]:
                        yield g.get_batch(int(k)).to_pandas()

        return spark.range(n).repartition(max(1, min(n, 200))).mapInPandas(run, from_arrow_schema(schema))
    raise ValueError(f"unsupported table: {path}")


def join_sidecar(df: DataFrame, path: str, key: str) -> DataFrame:
    """df with the fields of a JSON-lines sidecar, by key."""
    return df.join(df.sparkSession.read.json(path), key, "left")


def footer_counts(path: str) -> list[tuple[str, int]]:
    """(file, rows) of the Parquet files under a path, from their footers alone."""
    import pyarrow.parquet as pq

    return [(os.path.relpath(os.path.join(d, f), path), pq.ParquetFile(os.path.join(d, f)).metadata.num_rows) for d, _, fs in sorted(os.walk(path)) for f in sorted(fs) if f.endswith(".parquet")]


def html_text(column: str | Column) -> Column:
    """Visible text of HTML pages: scripts and styles dropped, blocks to lines, entities decoded."""
    from html import unescape

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> str | None:
            if page is None:
                return None
            t = re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ", page)
            t = re.sub(r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])\b[^>]*>", "\n", t)
            t = unescape(re.sub(r"<[^>]+>", " ", t))
            return "\n".join(x for x in (re.sub(r"[ \t\xa0]+", " ", line).strip() for line in t.split("\n")) if x)

        return pages.map(one)

    return run(column)


#: One extracted piece of a document: text with its place, on paged media with a page and a box in points.
SPANS = "document_id string, index int, kind string, text string, start_char int, end_char int, page int, box struct<left: double, top: double, right: double, bottom: double>, lane string"


def lane(media_type: Column, chars: Column | None = None, size: Column | None = None) -> Column:
    """The lanes a file goes through, in order: plain for text, html for pages, ocr for images, layout then metadata for sheets,
    metadata then layout for PDF, ocr as well where the text so far is too little for the size: under 64 signs or half one a KiB."""
    scanned = F.lit(False) if chars is None else chars < F.greatest(F.lit(64), size / 1024 * 0.5)
    pdf = F.when(scanned, F.array(F.lit("metadata"), F.lit("layout"), F.lit("ocr"))).otherwise(F.array(F.lit("metadata"), F.lit("layout")))
    sheet = media_type.endswith("sheet") | media_type.endswith("spreadsheet")
    return (
        F.when(media_type == "text/html", F.array(F.lit("html")))
        .when(media_type.startswith("text/"), F.array(F.lit("plain"), F.lit("metadata")))
        .when(media_type.startswith("image/"), F.array(F.lit("ocr")))
        .when(sheet, F.array(F.lit("layout"), F.lit("metadata")))
        .when(media_type == "application/pdf", pdf)
        .otherwise(F.array(F.lit("metadata")))
    )


def extract(files: DataFrame, lanes: dict[str, Callable[[bytes], list[tuple]]] | None = None) -> DataFrame:
    """SPANS of binary files (document_id, media_type, content): each goes through its lanes until one yields text.

    plain and html are built in; others are functions from bytes to (kind, text, page, box) that may be plugged in. A file that no
    lane can read is one row of kind error."""
    from html import unescape

    def plain(raw: bytes) -> list[tuple]:
        charset = charset_of(raw)
        return [] if charset is None else [("text", raw.decode(charset, "replace"), None, None)]

    def html(raw: bytes) -> list[tuple]:
        t = re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ", raw.decode(charset_of(raw) or "utf-8", "replace"))
        t = unescape(re.sub(r"<[^>]+>", " ", re.sub(r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])\b[^>]*>", "\n", t)))
        return [("text", "\n".join(x for x in (re.sub(r"[ \t\xa0]+", " ", line).strip() for line in t.split("\n")) if x), None, None)]

    known = {"plain": plain, "html": html} | (lanes or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, names, content in zip(pdf["document_id"], pdf["lanes"], pdf["content"]):
                for name in names:
                    spans = [x for x in known[name](bytes(content)) if x[1].strip()] if name in known else []
                    if spans:
                        at = 0
                        for k, (kind, text, page, box) in enumerate(spans):
                            rows.append((doc, k, kind, text, at, at + len(text), page, box, name))
                            at += len(text) + 1
                        break
                else:
                    rows.append((doc, 0, "error", None, None, None, None, None, None))
            frame = pd.DataFrame(rows, columns=["document_id", "index", "kind", "text", "start_char", "end_char", "page", "box", "lane"])
            yield frame.astype({"index": "int32", "start_char": "Int32", "end_char": "Int32", "page": "Int32"})

    return files.select("document_id", lane(F.col("media_type")).alias("lanes"), "content").mapInPandas(run, SPANS)


def extension_counts(paths: DataFrame, column: str = "relative_path", max_files: int | None = None) -> DataFrame:
    """(extension, files, truncated): files by extension, none as empty; truncated tells that only max_files were counted, if stated."""
    if max_files is not None:
        some = paths.limit(max_files + 1).count() > max_files
        paths = paths.orderBy(column).limit(max_files)
    else:
        some = False
    return paths.groupBy(F.lower(F.regexp_extract(column, r"\.([A-Za-z0-9]+)$", 1)).alias("extension")).agg(F.count("*").alias("files")).withColumn("truncated", F.lit(some))
