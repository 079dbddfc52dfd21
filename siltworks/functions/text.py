"""Text functions as columns. All stay in the JVM but ``norm`` of non-ASCII text."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import fixed

#: White space as Python's str.strip and regular expressions see it.
_WHITE = r"(?U)[\s\x1c-\x1f]"


#: Characters that NFKC leaves as they are, wherever they stand: ASCII, most of Latin, kana, ideographs and their marks.
_STABLE = r"\A[\x00-\x7f\u00a1-\u00a7\u00a9\u00ab-\u00ae\u00b0\u00b1\u00b6\u00b7\u00bb\u00bf-\u012f\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u3001-\u3003\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff]*\z"


@F.pandas_udf(StringType())
def _nfkc_lower(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).lower())


def norm(text: Column, nfkc: bool = True) -> Column:
    """NFKC and lower case.

    No built-in function does NFKC. Texts of characters that it never changes are
    lower-cased in the JVM and reach the Python step as nulls. ``nfkc=False``
    leaves that step out where the caller knows that it changes nothing.
    """
    if not nfkc:
        return F.lower(text)
    return F.coalesce(_nfkc_lower(F.when(~text.rlike(_STABLE), text)), F.lower(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_WHITE}+\z|\A{_WHITE[4:]}+", "")


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | text.rlike(rf"\A{_WHITE}*\z")


def without_white(text: Column) -> Column:
    return F.regexp_replace(text, f"{_WHITE}+", "")


def ngrams(text: Column, n: int = 5) -> Column:
    """Distinct character n-grams; a shorter text is its own one gram, the empty text too."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - (n - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(n))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / either)


def count_matches(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def credential_counts(text: Column) -> Column:
    """Array of match counts, one for each kind in order."""
    return F.array(*[count_matches(text, p) for _, p in fixed.CREDENTIAL_PATTERNS])


def credential_kinds(counts: Column, firsts: Column | None = None) -> Column:
    """Names of the kinds with a match, from an array of counts: by the line of their first match, else in order."""
    n = len(fixed.CREDENTIAL_PATTERNS)
    first = (lambda i: F.get(firsts, F.lit(i))) if firsts is not None else (lambda i: F.lit(0).cast("long"))
    found = F.array(*[F.when(F.get(counts, F.lit(i)) > 0, F.struct(first(i).alias("line"), F.lit(i).alias("i"), F.lit(fixed.CREDENTIAL_PATTERNS[i][0]).alias("kind"))) for i in range(n)])
    return F.transform(F.array_sort(F.array_compact(found)), lambda z: z["kind"])


def is_verification(surface: Column) -> Column:
    joined = "|".join(f"(?:{p})" for p in fixed.VERIFICATION_PATTERNS)
    return F.coalesce(surface.rlike(f"(?iU){joined}"), F.lit(False))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return F.coalesce(reduce(or_, [F.contains(text, F.lit(w)) for w in words]), F.lit(False)) if words else F.lit(False)


def first_contained(text: Column, words: Sequence[str], shown: Sequence[str] | None = None) -> Column:
    """The first of ``words`` in list order that the text contains, as ``shown`` spells it; null if none."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(s)) for w, s in zip(words, shown or words, strict=True)]) if words else F.lit(None).cast("string")


def is_refusal(normal: Column) -> Column:
    return contains_any(normal, fixed.REFUSAL_PHRASES)


def is_wrapper(normal: Column) -> Column:
    lead = F.regexp_replace(normal, rf"\A{_WHITE}+", "")
    return F.coalesce(F.greatest(*[F.startswith(lead, F.lit(p)).cast("int") for p in fixed.WRAPPER_PREFIXES]) == 1, F.lit(False))


def is_injected(text: Column) -> Column:
    """The whole message is one block of a tag that clients inject."""
    tag = F.regexp_extract(strip(text), r"\A<([A-Za-z0-9_:-]+)>(?s:.*)</\1>\s*\z", 1)
    return F.lower(tag).isin(*fixed.INJECTED_TAGS)


def preview(lines: Column, most: int = 180) -> Column:
    """First line of a prompt that is no scaffolding and longer than three characters, on one line."""
    trimmed = F.transform(F.split(lines, "\n"), lambda x: F.regexp_replace(x, r"\A[ \t\r]+", ""))
    scaffold = r"\A<|\A# (AGENTS\.md|Agent skills|user_instructions)|<environment_context>|<user_instructions>|<permissions"
    real = F.filter(trimmed, lambda x: ~x.rlike(scaffold) & (F.length(x) > 3))
    flat = F.regexp_replace(F.translate(F.get(real, F.lit(0)), "\t\r\n", "   "), " {2,}", " ")
    return F.coalesce(F.substring(flat, 1, most), F.lit(""))


def slug(cwd: Column, most: int = 60) -> Column:
    """A workspace path as part of a file name."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(cwd, r"\A/", ""), "/", "--"), r"[^A-Za-z0-9._-]", "_")
    return F.coalesce(F.nullif(F.substring(plain, 1, most), F.lit("")), F.lit("no-workspace"))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+\z", 0)


def one_line(text: Column) -> Column:
    """Tabs and line ends as spaces."""
    return F.translate(text, "\t\r\n", "   ")


def capability_of(tool: Column) -> Column:
    """Capability of a tool name, case ignored; null if unmapped."""
    known = F.create_map(*[F.lit(x) for cap, tools in fixed.CAPABILITY_TOOLS.items() for t in tools for x in (t, cap)])
    return F.try_element_at(known, F.lower(tool))
