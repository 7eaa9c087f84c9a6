"""Record ids, file-name keys and the year / thousand-bucket layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Published file names: prefix match, so "CVE-2024-1234.json.bak" passes.
PUBLISH_NAME_RE = r"^CVE-(\d{4})-(\d{4,7})\.json"
# An id anywhere inside a path or line
ID_IN_TEXT_RE = r"(CVE-\d{4}-\d{4,7})"
STAGED_SUFFIX = "_keyphrases.json"
BUCKET_SUFFIX = "xxx"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def publish_name_ok(name) -> Column:
    return _c(name).rlike(PUBLISH_NAME_RE)


def id_year(name) -> Column:
    return F.regexp_extract(_c(name), PUBLISH_NAME_RE, 1).cast("int")


def id_number(name) -> Column:
    return F.regexp_extract(_c(name), PUBLISH_NAME_RE, 2)


def bucket(number) -> Column:
    """Thousand bucket: ``int(n) // 1000`` followed by 'xxx', unpadded."""
    n = _c(number).cast("bigint")
    return F.concat(((n - n % 1000) / 1000).cast("bigint").cast("string"), F.lit(BUCKET_SUFFIX))


def folder(bucket_name) -> Column:
    """The folder that holds a thousand bucket: the bucket's own up to number
    99999; beyond, where numbers are sparse, one folder for each first digit
    (``123xxx`` -> ``1xxxxx``, ``1234xxx`` -> ``1xxxxxx``). A year has 118 folders
    at most, however far its numbers go. A folder's name gives itself."""
    six = F.regexp_replace(_c(bucket_name), r"^(\d)\d{2}xxx$", "$1xxxxx")
    return F.regexp_replace(six, r"^(\d)\d{3}xxx$", "$1xxxxxx")


def key_from_suffix(name) -> Column:
    """``CVE-…_keyphrases.json`` -> ``CVE-…`` (replace form)."""
    return F.replace(_c(name), F.lit(STAGED_SUFFIX), F.lit(""))


def key_from_split(name) -> Column:
    """Text before the first underscore (split form)."""
    return F.substring_index(_c(name), "_", 1)


def id_in_text(line) -> Column:
    """First id inside an arbitrary path or text line; '' when none."""
    return F.regexp_extract(_c(line), ID_IN_TEXT_RE, 1)
