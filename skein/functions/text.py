"""Text cleaning and string predicates as built-in Column expressions.

All functions map Column -> Column and stay inside whole-stage codegen
(regexp_replace / split / substring_index); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip() and re's \s see it, built from the
# rule itself: every code point for which str.isspace() holds (ASCII
# whitespace, the separators \x1c-\x1f, NEXT LINE, Unicode space separators).
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# --- fixed values -----------------------------------------------------------
# The same set as a Java regex class, for matching inside larger patterns.
WS_CLASS = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
# Characters deleted by the second cleaning step: ' " newline return : ;
PUNCT_CLASS = "['\"\n\r:;]"
# Markup tags
TAG_RE = "<[^>]+>"
# Runs of non-ASCII characters
NON_ASCII_RE = r"[^\x00-\x7F]+"
# Whitespace that survives the ASCII-only step
ASCII_WS_RE = r"[\s\x1c-\x1f]+"
# Kernel trace markers: a timestamp with a digit right after "[" or "[#"
KERNEL_PREFIX = "In the Linux kernel, the following vulnerability"
KERNEL_CUT_RE = r"\[\d+\.\d+\]|\[#"
KERNEL_BUG = "BUG kernel"
# Placeholder descriptions (matched case-insensitively, after cleaning)
PLACEHOLDERS = ("DO NOT USE THIS CANDIDATE NUMBER", "ConsultIDs",
                "Reason This candidate is a duplicate")
REJECTED = "REJECTED"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    A character-set trim, not a regex: ``\\s+$`` is retried at every
    position of a long text, the trim only looks at the two ends."""
    return F.trim(_c(c), F.lit(WS_CHARS))


def blank(c) -> Column:
    """True when null, empty or whitespace only (``fillna('').strip() == ''``)."""
    return strip(F.coalesce(_c(c), F.lit(""))) == F.lit("")


def strip_html(c) -> Column:
    return F.regexp_replace(_c(c), TAG_RE, "")


def strip_punct(c) -> Column:
    return F.regexp_replace(_c(c), PUNCT_CLASS, "")


def ascii_only(c) -> Column:
    return F.regexp_replace(_c(c), NON_ASCII_RE, "")


def collapse_ws(c) -> Column:
    """Collapse whitespace runs to one space and strip the ends."""
    return strip(F.regexp_replace(_c(c), r"[\s\x0B\x1c-\x1f\x85\p{Z}]+", " "))


def clean_description(c) -> Column:
    """Five ordered steps: null -> '', tags, punctuation, non-ASCII, spaces.

    Newlines are deleted (not turned into spaces) because the punctuation
    step runs before whitespace is collapsed.
    """
    x = F.coalesce(_c(c).cast("string"), F.lit(""))
    x = strip_html(x)
    x = strip_punct(x)
    x = ascii_only(x)
    return strip(F.regexp_replace(x, ASCII_WS_RE, " "))


def trim_kernel_trace(c) -> Column:
    """Cut kernel reports before the first trace marker and before 'BUG kernel'."""
    x = _c(c)
    head = strip(F.split(x, KERNEL_CUT_RE, 2).getItem(0))
    cut = strip(F.substring_index(head, KERNEL_BUG, 1))
    return F.when(x.startswith(KERNEL_PREFIX), cut).otherwise(x)


def is_rejected(state) -> Column:
    """Null-safe ``state == 'REJECTED'`` (a missing state is not rejected)."""
    return _c(state).eqNullSafe(F.lit(REJECTED))


def rejected_fill(desc, state, reason) -> Column:
    """Rejected records with a blank description take the rejection reason."""
    return F.when(is_rejected(state) & blank(desc), _c(reason)).otherwise(_c(desc))


def keep_not_rejected_blank(desc, state) -> Column:
    """Keep unless rejected *and* still blank; null state is kept."""
    return ~is_rejected(state) | ~blank(desc)


def is_placeholder(c) -> Column:
    low = F.lower(_c(c))
    cond = F.lit(False)
    for p in PLACEHOLDERS:
        cond = cond | low.contains(p.lower())
    return cond


def keep_valid_text(c) -> Column:
    """Drop blank and placeholder descriptions."""
    return _c(c).isNotNull() & ~blank(c) & ~F.coalesce(is_placeholder(c), F.lit(False))


def truncate_200(c) -> Column:
    """First 200 characters plus '...' when longer; code points."""
    x = _c(c)
    return F.when(F.length(x) > 200, F.concat(F.substring(x, 1, 200), F.lit("..."))).otherwise(x)


def text_length(c) -> Column:
    return F.coalesce(F.length(_c(c)), F.lit(0))


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    ``fn`` may read its argument many times without copying the producing
    expression into the plan (nested CASE chains over a regex otherwise
    grow the generated code exponentially)."""
    return F.transform(F.array(_c(value)), fn).getItem(0)
