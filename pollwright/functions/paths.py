"""Columns that file paths carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollwright.constants import FORMATS

# --- fixed values: file name forms ------------------------------------------
DOCUMENT_PATH = r"([^/]+)/([^/]+)/([^/]+)/([^/]+)\.([^/.]+)$"
RESULT_SUFFIX = "_converted_prompts.csv"
ITEMS_SUFFIX = "_qa_pairs"
FORMAT_TAG = rf"_({'|'.join(FORMATS)})_converted_prompts\.csv"
# ----------------------------------------------------------------------------


def decoded(path: Column) -> Column:
    """A file's path as it is on disk: Spark gives it percent-encoded, ``+`` as it is."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def document_keys(path: Column) -> dict[str, Column]:
    """Keys in ``…/{dataset}/{task}/{format}/{case_id}.{format}``."""
    part = lambda n: F.regexp_extract(path, DOCUMENT_PATH, n)
    return {"dataset": part(1), "task": part(2), "format": part(3), "case_id": part(4)}


def is_document(path: Column) -> Column:
    """The folder's format is also the file's ending."""
    return path.rlike(r"/([^/]+)/[^/]+\.\1$")


def format_tag(file_name: Column) -> Column:
    """The known format in a result file's name, null where there is none."""
    return F.nullif(F.regexp_extract(file_name, FORMAT_TAG, 1), F.lit(""))


def relative_to(path: Column, base: str) -> Column:
    """What follows ``base`` in a path, scheme and leading part aside."""
    base = base.split(":", 1)[-1].rstrip("/").lstrip("/") + "/"
    return F.substring(path, F.locate(base, path) + len(base), F.length(path))


def result_keys(relative: Column) -> dict[str, Column]:
    """Keys in ``{dataset}/{task}/{file}``; format is null for other files."""
    parts = F.split(relative, "/")
    return {
        "dataset": F.get(parts, F.lit(0)),
        "dir_task": F.get(parts, F.lit(1)),
        "format": format_tag(F.get(parts, F.lit(2))),
    }


def catalogue_task(stem: Column, dataset: Column) -> Column:
    """Task named by the stem ``{dataset}_{task}_qa_pairs`` of an items file."""
    rest = F.replace(stem, F.concat(dataset, F.lit("_")), F.lit(""))
    return F.replace(rest, F.lit(ITEMS_SUFFIX), F.lit(""))
