"""Scalar expressions and predicates (F1-F25, P1-P15) as Column builders.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- identifiers ----------------------------------------------------------

def data_class(id_col: ColumnOrName) -> Column:
    """``FBgn0000490`` -> ``FBgn`` (chars 1-2 upper, 3-4 lower)."""
    c = _c(id_col)
    return F.concat(F.upper(F.substring(c, 1, 2)), F.lower(F.substring(c, 3, 2)))


def id_pattern(prefixes: str | list[str]) -> str:
    """Java regex for whole ids of the given 4-letter classes: ``^FB(gn|al)[0-9]+\\z``.

    ``\\z`` (not ``$``): Java's ``$`` also matches before a trailing newline.
    """
    if isinstance(prefixes, str):
        prefixes = [prefixes]
    heads = {p[:2] for p in prefixes}
    if len(heads) == 1:
        tails = "|".join(p[2:] for p in prefixes)
        body = f"{prefixes[0][:2]}({tails})" if len(prefixes) > 1 else prefixes[0]
    else:
        body = "(" + "|".join(prefixes) + ")"
    return f"^{body}[0-9]+\\z"


def is_id_of(id_col: ColumnOrName, prefixes: str | list[str]) -> Column:
    """Uniquename matches one of the classes.  The prefix test beside the
    pattern is one that a Parquet scan can apply to its statistics."""
    c, starts = _c(id_col), None
    for p in [prefixes] if isinstance(prefixes, str) else prefixes:
        starts = c.startswith(p) if starts is None else starts | c.startswith(p)
    return starts & c.rlike(id_pattern(prefixes))


def live(prefixes: str | list[str], uniquename="uniquename", is_analysis="is_analysis",
         is_obsolete="is_obsolete") -> Column:
    """A live row of the class: id pattern, not analysis, not obsolete."""
    cond = is_id_of(uniquename, prefixes) & ~_c(is_obsolete)
    if is_analysis is not None:
        cond = cond & ~_c(is_analysis)
    return cond


def similar_to_regex(pattern: str) -> str:
    """P5: translate SQL ``SIMILAR TO`` into an anchored Java regex.

    ``%`` -> ``.*`` and ``_`` -> ``.`` (newlines included); ``|``, ``*``,
    ``+``, ``?``, ``{m,n}``, parentheses and bracket expressions keep their
    meaning; a backslash quotes the next character; everything else is
    literal.  Whole-string match like SQL.
    """
    out, i, bracket = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        elif bracket:
            bracket = ch != "]"
            out.append("\\[" if ch == "[" else ch)
        elif ch == "[":
            bracket = True
            out.append(ch)
        elif ch in "%_":
            out.append(".*" if ch == "%" else ".")
        else:
            out.append(ch if ch in "|()*+?{}" else re.escape(ch))
        i += 1
    dotall = "(?s)" if any(x in (".", ".*") for x in out) else ""
    return dotall + "\\A(?:" + "".join(out) + ")\\z"


def similar_to(col: ColumnOrName, pattern: str) -> Column:
    """P5 as a Column: literal alternations become ``isin`` (no regex)."""
    if not any(ch in pattern for ch in "%_()[]*+?{}\\.^$"):
        return _c(col).isin(pattern.split("|"))
    return _c(col).rlike(similar_to_regex(pattern))


# --- evidence -------------------------------------------------------------

# fixed values: experimental GO evidence phrases
EXPERIMENTAL_EVIDENCE = (
    "inferred from (physical interaction|direct assay|genetic interaction|mutant phenotype|"
    "expression pattern|(high throughput (experiment|direct assay|expression pattern|"
    "genetic interaction|mutant phenotype)))"
)


def is_evidence_experimental(col: ColumnOrName, case_sensitive: bool = False) -> Column:
    """unanchored match; case-insensitive like ``~*`` unless asked."""
    prefix = "" if case_sensitive else "(?i)"
    return _c(col).rlike(prefix + EXPERIMENTAL_EVIDENCE)


def has_word(col: ColumnOrName, words: list[str]) -> Column:
    """Word-boundary match (PostgreSQL ``\\y``) of any of ``words``."""
    return _c(col).rlike("\\b(" + "|".join(words) + ")\\b")


# --- strings --------------------------------------------------------------

def concat_skip_null(*cols: ColumnOrName) -> Column:
    """SQL ``CONCAT()``: NULL arguments count as empty strings."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def regex_substr(col: ColumnOrName, pattern: str) -> Column:
    """First match of ``pattern`` or NULL when there is none."""
    return F.regexp_substr(_c(col), F.lit(pattern))


def split_part(col: ColumnOrName, sep_regex: str, n: int) -> Column:
    """``regexp_split_to_array(x, sep)[n]`` (1-based); NULL past the end."""
    return F.get(F.split(_c(col), sep_regex), n - 1)


def list_size(col: ColumnOrName, sep_regex: str) -> Column:
    """``cardinality(string_to_array(x, sep))``; NULL stays NULL."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.size(F.split(c, sep_regex)))


def replace_first(col: ColumnOrName, literal: str, replacement: str = "") -> Column:
    """F10 (Python ``str.replace(x, y, 1)``): replace the first occurrence."""
    return F.regexp_replace(_c(col), "(?s)^(.*?)" + re.escape(literal), "$1" + replacement.replace("$", "\\$"))


# --- summaries (F23) ------------------------------------------------------

# fixed values: labels of the summary a gene page shows, in priority order
SUMMARY_LABELS = ("Gene Snapshot", "UniProt Function", "Interactive Fly", "Alliance Gene Description",
                  "Automatic summary")


def selected_summary(snapshot, uniprot, pathway, group, interactive_fly, external) -> Column:
    """which summary a gene page shows.  Pathway and group counts do not
    take part (their tests are disabled in the reference)."""
    snap, uni, ifly, ext, auto = SUMMARY_LABELS
    return (
        F.when(_c(snapshot) >= 1, snap)
        .when(_c(uniprot) >= 1, uni)
        .when(_c(interactive_fly) >= 1, ifly)
        .when(_c(external) >= 1, ext)
        .otherwise(auto)
    )


# --- locations (F21) ------------------------------------------------------

LOCATION_RE = r"^(\w+):(\d+)\.\.(\d+)$"


def parse_location(col: ColumnOrName):
    """``scaffold:min..max`` after dropping commas and outer blanks.

    Returns (scaffold, fmin, fmax) Columns; all NULL when malformed.
    """
    s = F.regexp_replace(F.trim(_c(col)), ",", "")
    ok = s.rlike(r"^\w+:\d+\.\.\d+\z")
    scaffold = F.when(ok, F.regexp_extract(s, LOCATION_RE, 1))
    fmin = F.when(ok, F.regexp_extract(s, LOCATION_RE, 2).try_cast("long"))
    fmax = F.when(ok, F.regexp_extract(s, LOCATION_RE, 3).try_cast("long"))
    return scaffold, fmin, fmax
