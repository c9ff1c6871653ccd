"""Columns derived from object keys and file names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content types by file suffix, from the public media type registry.
CONTENT_TYPES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "jpe": "image/jpeg", "png": "image/png",
    "gif": "image/gif", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff",
    "webp": "image/webp", "avif": "image/avif", "heic": "image/heic", "heif": "image/heif",
    "svg": "image/svg+xml", "ico": "image/vnd.microsoft.icon",
    "mp4": "video/mp4", "m4v": "video/mp4", "mpa": "video/mpeg", "mpe": "video/mpeg",
    "mpeg": "video/mpeg", "mpg": "video/mpeg", "mov": "video/quicktime",
    "qt": "video/quicktime", "webm": "video/webm", "avi": "video/x-msvideo",
    "mkv": "video/x-matroska", "wmv": "video/x-ms-wmv", "ogv": "video/ogg", "flv": "video/x-flv",
    "mp3": "audio/mpeg", "wav": "audio/x-wav", "aac": "audio/aac",
    "json": "application/json", "xml": "application/xml", "csv": "text/csv", "txt": "text/plain",
    "html": "text/html", "htm": "text/html", "pdf": "application/pdf",
    "obj": "model/obj", "stl": "model/stl", "gltf": "model/gltf+json",
    "glb": "model/gltf-binary", "las": "application/vnd.las",
    "zip": "application/zip", "tar": "application/x-tar", "bin": "application/octet-stream",
}
OTHER_CONTENT = "application/octet-stream"
NO_SUFFIX = "bin"


def suffix(object_key: Column) -> Column:
    """Lower-cased suffix of the last path part, empty when there is none."""
    return F.lower(F.regexp_extract(object_key, r"^(?:.*/)?[^/]*[^./][^/]*\.([^./]+)/*$", 1))


def object_format(object_key: Column) -> Column:
    found = suffix(object_key)
    return F.when(found == "", F.lit(NO_SUFFIX)).otherwise(found)


def content_type(object_key: Column) -> Column:
    """Content type of a file name; compressed files take the type of what they hold."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(CONTENT_TYPES.items())])
    held = F.regexp_replace(object_key, r"(?i)\.(gz|bz2|xz|br)$", "")
    return F.coalesce(F.try_element_at(table, suffix(held)), F.lit(OTHER_CONTENT))


def file_safe(name: Column, ending: str = "") -> Column:
    """A name reduced to letters, digits, ``_``, ``.`` and ``-``."""
    cleaned = F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "-"), F.lit("-"))
    return F.concat(F.when(cleaned == "", F.lit("dataset")).otherwise(cleaned), F.lit(ending))
