"""Object-key expressions: routing, decoding and key algebra."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import col

# Suffix routes of the ingestion buckets (case-sensitive).
PDF_SUFFIXES = [".pdf"]
OFFICE_SUFFIXES = [".ppt", ".pptx", ".docx", ".xlsx", ".xls", ".excel", ".html"]
VIDEO_SUFFIXES = [".mp4"]

# Conversion profiles by lower-cased extension.
DOC_EXTS = [".doc", ".docx"]
SHEET_EXTS = [".xls", ".xlsx", ".csv"]
SLIDE_EXTS = [".ppt", ".pptx"]

# Upload types by lower-cased last dot segment.
UPLOAD_TYPES = {"csv": "csv", "doc": "doc", "docx": "docx", "htm": "html",
                "html": "html", "md": "md", "pdf": "pdf", "txt": "txt",
                "xls": "sheet", "xlsx": "sheet"}

# splitext: leading dots of a name belong to the name, not to an extension.
EXT_RE = r"(?s)^\.*[^.].*(\.[^.]*)$"
STEM_RE = r"(?s)^(\.*[^.].*)\.[^.]*$"


def _ends_any(c: Column, suffixes, ignore_case: bool) -> Column:
    target = F.lower(c) if ignore_case else c
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | target.endswith(s.lower() if ignore_case else s)
    return cond


def route(key, ignore_case: bool = False) -> Column:
    """pdf / office / video / NULL by suffix. A converted office file comes
    back as ``.pdf`` and so re-enters the pdf route."""
    k = col(key)
    return (F.when(_ends_any(k, PDF_SUFFIXES, ignore_case), F.lit("pdf"))
            .when(_ends_any(k, OFFICE_SUFFIXES, ignore_case), F.lit("office"))
            .when(_ends_any(k, VIDEO_SUFFIXES, ignore_case), F.lit("video")))


def extension(key) -> Column:
    """``os.path.splitext`` extension of the basename ('' when none)."""
    base = F.substring_index(col(key), "/", -1)
    return F.regexp_extract(base, EXT_RE, 1)


def conversion_profile(key) -> Column:
    ext = F.lower(extension(key))
    return (F.when(ext.isin(DOC_EXTS), F.lit("doc"))
            .when(ext.isin(SHEET_EXTS), F.lit("sheet"))
            .when(ext.isin(SLIDE_EXTS), F.lit("slide"))
            .otherwise(F.lit("other")))


def upload_type(name) -> Column:
    last = F.element_at(F.split(F.lower(col(name)), r"\."), -1)
    m = F.create_map(*[x for kv in UPLOAD_TYPES.items() for x in map(F.lit, kv)])
    return F.coalesce(F.element_at(m, last), F.lit("unsupported"))


def decode_key(key) -> Column:
    """``unquote_plus``: '+' is a space, %XX decoded; malformed -> NULL."""
    return F.try_url_decode(col(key))


def basename(key) -> Column:
    return F.substring_index(col(key), "/", -1)


def strip_ext(key) -> Column:
    base = basename(key)
    stem = F.regexp_replace(base, STEM_RE, "$1")
    return F.concat(F.substring(col(key), 1, F.length(col(key)) - F.length(base)), stem)


def pdf_key(key) -> Column:
    return F.concat(strip_ext(key), F.lit(".pdf"))


def txt_key(key) -> Column:
    return F.concat(col(key), F.lit(".txt"))


def converted_key(key, prefix: str = "converted") -> Column:
    return F.concat(F.lit(prefix + "/"), basename(pdf_key(key)))


def json_to_txt(key) -> Column:
    """Every '.json' occurrence replaced, like ``str.replace``."""
    return F.replace(col(key), F.lit(".json"), F.lit(".txt"))


def bucket_from_arn(arn) -> Column:
    return F.element_at(F.split(col(arn), ":"), -1)


def page_ordinal(name) -> Column:
    """``page_(\\d+)\\.png`` -> int, NULL when absent (sorts last)."""
    num = F.regexp_extract(col(name), r"page_(\d+)\.png", 1)
    return F.nullif(num, F.lit("")).try_cast("int")
