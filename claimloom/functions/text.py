"""Text normalisers, matchers and identities as Column expressions.

Three normal forms exist side by side and must not be merged: exact text (identity),
claim text (comparison) and selector text (anchoring).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as the web platform knows it; Java's Unicode class lacks U+FEFF.
_SPACE = r"(?U)[\s\x{FEFF}]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _normal(form: str):
    @F.pandas_udf(T.StringType())
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    return normal


_nfkc, _nfkd = _normal("NFKC"), _normal("NFKD")
_ASCII = r"^[\x00-\x7F]*$"


def _beyond_ascii(x: Column, normal) -> Column:
    """``normal(x)`` for text beyond ASCII; ASCII text, which no normal form changes, stays in the JVM (Python is sent a null)."""
    return F.coalesce(normal(F.when(~x.rlike(_ASCII), x)), x)


def nfkc(x: Column | str) -> Column:
    """Compatibility composition."""
    return _beyond_ascii(_c(x), _nfkc)


def nfkd(x: Column | str) -> Column:
    """Compatibility decomposition."""
    return _beyond_ascii(_c(x), _nfkd)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_each(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFKC", x) for x in xs])


def nfkc_each(xs: Column) -> Column:
    """:func:`nfkc` of each text of an array; arrays of ASCII texts stay in the JVM."""
    plain = F.forall(xs, lambda x: F.coalesce(x.rlike(_ASCII), F.lit(True)))
    return F.coalesce(_nfkc_each(F.when(~plain, xs)), xs)


def lower(x: Column) -> Column:
    """Lower case; ASCII text, most of all keys and DOIs, without the slower way of Unicode's special cases."""
    return F.when(x.rlike(_ASCII), F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(x))


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, _SPACE, " "))


def exact_text(x: Column | str) -> Column:
    return collapse(nfkc(x))


def normalize_claim(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(exact_text(x)), r"(?U)[\p{P}\p{S}]+", " "), r"(?U)\s+", " "))


def claim_id(section: Column | str, text: Column | str) -> Column:
    return F.concat(F.lit("clm_"), F.substring(F.sha2(F.concat(_c(section), F.lit("\n"), exact_text(text)), 256), 1, 16))


#: An accent as TeX writes it.
TEX_ACCENT = r"""\\['"`^~=.]?"""


def canonical_author(x: Column | str) -> Column:
    lowered = F.regexp_replace(F.lower(nfkd(x)), TEX_ACCENT, "")
    return F.trim(F.regexp_replace(lowered, r"(?U)[{}\p{P}\p{S}\s]+", " "))


#: Inline Markdown and what stays of it, in order.
INLINE_MARKDOWN = [
    (r"(?i)\{cite(?::[a-z]+)?\}`[^`]+`", ""),
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]+)\]\([^)]*\)", "$1"),
    (r"(\*\*|__)(.*?)\1", "$2"),
    (r"(\*|_)(.*?)\1", "$2"),
    (r"`([^`]+)`", "$1"),
    (r"<[^>]+>", ""),
]


def strip_inline_markdown(x: Column | str) -> Column:
    out = _c(x)
    for pattern, kept in INLINE_MARKDOWN:
        out = F.regexp_replace(out, pattern, kept)
    return out


def markers(x: Column | str, words: list[str]) -> Column:
    """All whole-word matches in order, repeats included, whatever their case."""
    return F.regexp_extract_all(_c(x), F.lit(rf"(?i)(?<![A-Za-z0-9_])(?:{'|'.join(words)})(?![A-Za-z0-9_])"), F.lit(0))


def radar_text(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(nfkc(F.coalesce(_c(x), F.lit("")))), r"[^\p{L}\p{N}]+", " "))


def radar_doi(x: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(_c(x), F.lit("")))), r"^https?://(?:dx\.)?doi\.org/", "")


def topic_tokens(query: Column | str) -> Column:
    return F.filter(F.split(radar_text(query), " "), lambda t: F.length(t) > 2)


def topic_match(tokens: Column, haystack: Column) -> Column:
    """Every token is a substring; no tokens match nothing."""
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: F.contains(haystack, t))


def split_list(x: Column | str, by: str = ",") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(_c(x), F.lit("")), by), lambda v: F.trim(v)), lambda v: v != "")


def sorted_unique(x: Column | str) -> Column:
    return F.array_sort(F.array_distinct(_c(x)))


def set_diff(before: Column | str, after: Column | str) -> Column:
    empty = lambda a: F.coalesce(_c(a), F.array().cast("array<string>"))
    return F.struct(sorted_unique(F.array_except(empty(after), empty(before))).alias("added"), sorted_unique(F.array_except(empty(before), empty(after))).alias("removed"))


def stable_token(x: Column | str, fallback: str) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", F.lit(fallback)).otherwise(slug)


def unquoted(x: Column | str) -> Column:
    return F.regexp_replace(F.trim(_c(x)), r"""^(["'])(.*)\1$""", "$2")


def extract_doi(x: Column | str) -> Column:
    return F.regexp_extract(_c(x), r"10\.\d{4,}/[^\s,;)]+", 0)


def cite_keys(x: Column | str) -> Column:
    """Keys of all citation roles, several in one role taken apart."""
    groups = F.regexp_extract_all(_c(x), F.lit(r"\{cite(?::[a-z]+)?\}`([^`]+)`"), F.lit(1))
    return F.flatten(F.transform(groups, lambda g: split_list(g)))


def word_count(x: Column | str) -> Column:
    text = exact_text(x)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def word_set(x: Column | str) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(_c(x)), r"(?U)\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def title_overlap(a: Column | str, b: Column | str, first: int = 10) -> Column:
    x, y = (F.array_distinct(F.slice(word_set(t), 1, first)) for t in (a, b))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y), F.lit(1))


#: Words too common to show that two sentences share content.
STOP_WORDS = "that this with from have were been their which these those into than then also such using used between within".split()


def shared_content_words(a: Column | str, b: Column | str) -> Column:
    content = lambda t: F.filter(F.array_distinct(F.split(F.lower(_c(t)), r"[^a-z]+")), lambda w: (F.length(w) >= 4) & ~w.isin(STOP_WORDS))
    return F.size(F.array_intersect(content(a), content(b)))


def is_ascii(x: Column | str) -> Column:
    return _c(x).rlike(_ASCII)


def ascii_fold(x: Column | str) -> Column:
    return F.regexp_replace(nfkd(x), r"[^\x00-\x7F]", "")


def braces_balance(x: Column | str) -> Column:
    return F.regexp_count(_c(x), F.lit(r"\{")) == F.regexp_count(_c(x), F.lit(r"\}"))


#: Citation roles that don't parse, and commas doubled by deletions.
MALFORMED = [r"\{cite[^}]*\}(?!`)", r"\{cite[^}]*\}``", r"\{cite[^}]*\}`\s*,", r",\s*,"]


def malformed_count(x: Column | str) -> Column:
    return sum((F.regexp_count(_c(x), F.lit(p)) for p in MALFORMED), F.lit(0))


def markdown_cell(x: Column | str) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(_c(x).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\r?\n", " ")


def escape_html(x: Column | str) -> Column:
    out = F.coalesce(_c(x), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def truncate(x: Column | str, n: int) -> Column:
    return F.when(F.length(_c(x)) > n, F.concat(F.substring(_c(x), 1, n), F.lit("…"))).otherwise(_c(x))


def initials(x: Column | str) -> Column:
    return F.upper(F.array_join(F.transform(F.filter(F.split(F.trim(_c(x)), r"\s+"), lambda w: w != ""), lambda w: F.substring(w, 1, 1)), ""))


def first_name(x: Column | str) -> Column:
    return F.element_at(F.split(F.trim(_c(x)), r"\s+"), 1)


def last_name(x: Column | str) -> Column:
    return F.element_at(F.split(F.trim(_c(x)), r"\s+"), -1)


def fold_role(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_c(x)), r"[\x{2010}-\x{2015}\-]", " "), r"\s+", " "))


def title_label(x: Column | str) -> Column:
    """Words separated and their first letters raised; other letters stay as they are."""
    ws = F.filter(F.split(F.regexp_replace(_c(x), "[_-]+", " "), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(ws, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2), F.length(w)))), " ")


def claim_uri(base: Column | str, release: Column | str, claim: Column | str) -> Column:
    return F.concat(F.regexp_replace(_c(base), "/$", ""), F.lit("/"), _c(release), F.lit("/claims/"), _c(claim))


def source_path(x: Column | str) -> Column:
    """The path after the last ``/content/``, or the text itself."""
    return F.regexp_replace(_c(x), r"^.*/content/", "content/")


def semver_key(x: Column | str) -> Column:
    return F.transform(F.split(_c(x), r"\."), lambda p: p.cast("int"))


def safe_https(x: Column | str) -> Column:
    return F.coalesce(F.try_parse_url(_c(x), F.lit("PROTOCOL")) == "https", F.lit(False)) & F.try_parse_url(_c(x), F.lit("USERINFO")).isNull()


def safe_relative_path(x: Column | str) -> Column:
    parts = F.split(_c(x), "/")
    return (_c(x) != "") & ~_c(x).rlike(r"^/|\\|^[A-Za-z]:") & F.forall(parts, lambda p: ~p.isin("", ".", ".."))


# --- selector text: typography folded character by character, with places in the source -----------------

#: Typographic characters and their plain forms; the soft hyphen goes.
TYPOGRAPHY = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "­": ""}


def _select(text: str) -> tuple[str, list[int]]:
    out, at = [], []
    for i, c in enumerate(text):
        for k in unicodedata.normalize("NFKC", TYPOGRAPHY.get(c, c)):
            if k.isspace() or k == "﻿":
                if not out or out[-1] == " ":
                    continue
                k = " "
            out.append(k)
            at.append(i)
    while out and out[-1] == " ":
        out.pop()
        at.pop()
    return "".join(out), at


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("place", T.ArrayType(T.IntegerType()))]))
def selector_text(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_select(x or "") for x in s], columns=["text", "place"])


def find_unique(text: str, exact: str, prefix: str, suffix: str) -> tuple[int, int] | None:
    """Start and end in ``text`` of the one place where the quote stands between its contexts; overlapping places all count."""
    hay, place = _select(text)
    want, before, after = _select(exact)[0], _select(prefix)[0], _select(suffix)[0]
    if not want:
        return None
    found, at = [], hay.find(want)
    while at >= 0:
        end = at + len(want)
        if hay[:at].rstrip().endswith(before.strip()) and hay[end:].lstrip().startswith(after.strip()):
            found.append((place[at], place[end - 1] + 1))
        at = hay.find(want, at + 1)
    return found[0] if len(found) == 1 else None


@F.pandas_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
def quote_place(text: pd.Series, exact: pd.Series, prefix: pd.Series, suffix: pd.Series) -> pd.DataFrame:
    rows = [find_unique(a or "", b or "", c or "", d or "") or (None, None) for a, b, c, d in zip(text, exact, prefix, suffix)]
    return pd.DataFrame(rows, columns=["start", "end"], dtype="Int32")
