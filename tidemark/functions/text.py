"""Text as columns: normal form, URLs, tokens, similarity, keyword patterns.

Regular expressions carry (?U), so that letters, digits and spaces are Unicode's.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark import fixed

SPACE = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unescape(t))


@F.pandas_udf(StringType())
def _content(texts: pd.Series, verbatim: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else unescape(re.sub("<[^>]+>", " ", t if v else unescape(t))) for t, v in zip(texts, verbatim, strict=True)], dtype=object)


def nfkc(text: Column) -> Column:
    """Compatibility composition. ASCII, which it can't change, reaches the plan's Python node as null and costs no work there."""
    plain = F.octet_length(text) == F.length(text)
    return F.coalesce(F.when(plain, text), _nfkc(F.when(~plain, text)))


def normalize_text(text: Column) -> Column:
    """NFKC, URLs to a space, lower case, white space collapsed and stripped."""
    return plain_form(nfkc(text))


def plain_form(text: Column) -> Column:
    """normalize_text for text that is known to be in NFKC: wholly within generated code."""
    return F.btrim(F.regexp_replace(F.lower(F.regexp_replace(text, r"(?U)https?://[^\s\x1c-\x1f]+", " ")), SPACE, " "), F.lit(" "))


def strip_markup(text: Column) -> Column:
    """Tags to a space, character references resolved, stripped. Text without an ampersand reaches the plan's Python node as null."""
    bare = F.regexp_replace(text, "<[^>]+>", " ")
    has = F.contains(bare, F.lit("&"))
    return trim_space(F.coalesce(F.when(~has, bare), _unescape(F.when(has, bare))))


def content_of(text: Column, verbatim: Column) -> Column:
    """strip_markup of a tag's content, whose references are resolved first unless it is verbatim (CDATA): both in one Python function, which text without an ampersand reaches as null."""
    has = F.contains(text, F.lit("&"))
    return trim_space(F.coalesce(F.when(~has, F.regexp_replace(text, "<[^>]+>", " ")), _content(F.when(has, text), verbatim)))


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def summarize(text: Column, most: int = fixed.SUMMARY_CHARS) -> Column:
    """White space collapsed; cut at most characters, with an ellipsis."""
    flat = F.btrim(F.regexp_replace(text, SPACE, " "), F.lit(" "))
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most)), F.lit("…")))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no www., default port, tracking parameters, fragment or trailing slash; parameters sorted."""
    u = trim_space(url)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    scheme = F.when(scheme == "", F.lit("https")).otherwise(scheme)
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    default = F.when(scheme == "https", F.lit(":443")).when(scheme == "http", F.lit(":80")).otherwise(F.lit("\x00"))
    host = F.when(F.endswith(host, default), F.regexp_replace(host, ":[0-9]+$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("k"),
            F.when(F.contains(p, F.lit("=")), _decoded(F.substring(p, F.instr(p, "=") + 1, F.length(p)))).otherwise(F.lit("")).alias("v"),
        ),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*fixed.TRACKING)))
    text = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    return F.concat(scheme, F.lit("://"), host, path, F.when(text == "", F.lit("")).otherwise(F.concat(F.lit("?"), text)))


def _decoded(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), part)


def _encoded(part: Column) -> Column:
    """Form encoding: Java's, but for the tilde kept and the asterisk encoded."""
    return F.replace(F.replace(F.url_encode(part), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the normal forms of the parts that aren't empty, one a line."""
    normal = [F.when(p != "", normalize_text(p)) for p in parts]
    return F.sha2(F.concat_ws("\n", *normal), 256)


def short_hash(*parts: Column, length: int = 10) -> Column:
    return F.substring(F.sha2(F.concat_ws(" ", *parts), 256), 1, length)


def slug(text: Column) -> Column:
    """Letters a-z and digits with _ between, 60 at most; a hash where nothing is left."""
    normal = normalize_text(text)
    s = F.btrim(F.regexp_replace(normal, "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(s == "", short_hash(normal, length=12)).otherwise(F.substring(s, 1, 60))


def tokens(normal: Column) -> Column:
    """The distinct tokens of normalised text: Latin words of more than one character, and pairs of CJK characters."""
    words = F.filter(F.regexp_extract_all(normal, F.lit(r"([a-z0-9]+(?:[.\-_][a-z0-9]+)*)"), 1), lambda w: F.length(w) > 1)
    runs = F.regexp_extract_all(normal, F.lit(f"([{fixed.CJK}]+)"), 1)
    pairs = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) == 1, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2))))))
    return F.array_distinct(F.concat(words, pairs))


_WORD = re.compile(r"[a-z0-9]+(?:[.\-_][a-z0-9]+)*")
_RUN = re.compile(f"[{fixed.CJK}]+")


def _lowered(text: str) -> str:
    """_normal without its last step: white space is as it was."""
    t = text if text.isascii() else unicodedata.normalize("NFKC", text)
    return (re.sub(r"https?://\S+", " ", t) if "://" in t else t).lower()


def _tokens(lowered: str) -> list[str]:
    """As tokens does, of lower-cased text."""
    found = dict.fromkeys(w for w in _WORD.findall(lowered) if len(w) > 1)
    if not lowered.isascii():
        for run in _RUN.findall(lowered):
            found.update(dict.fromkeys([run] if len(run) == 1 else [run[i : i + 2] for i in range(len(run) - 1)]))
    return list(found)


@F.arrow_udf(ArrayType(StringType()))
def _tokens_of(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _tokens(_lowered(t)) for t in texts.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(StructType([StructField("title", StringType()), StructField("content_hash", StringType()), StructField("tokens", ArrayType(StringType()))]))
def _compared(titles: pa.Array, bodies: pa.Array) -> pa.Array:
    title, hashed, words = [], [], []
    for parts in zip(titles.to_pylist(), bodies.to_pylist(), strict=True):
        low = [_lowered(p) for p in parts]
        flat = [" ".join(t.split()) for t in low]
        title.append(flat[0])
        hashed.append(hashlib.sha256("\n".join(f for f, p in zip(flat, parts, strict=True) if p).encode()).hexdigest())
        words.append(_tokens("\n".join(low)))
    return pa.StructArray.from_arrays([pa.array(title, pa.string()), pa.array(hashed, pa.string()), pa.array(words, pa.list_(pa.string()))], ["title", "content_hash", "tokens"])


# not deterministic, as the plan would else repeat them in every filter and column that reads them
_tokens_of, _compared = _tokens_of.asNondeterministic(), _compared.asNondeterministic()


def tokens_of(text: Column) -> Column:
    """tokens(normalize_text(text)), in one pass of Python over the text; lists of expressions evaluate the normal form once a regular expression and reader."""
    return _tokens_of(text)


def compared(title: Column, body: Column) -> Column:
    """title: normalize_text(title), content_hash(title, body), and tokens of both, one a line, of texts that aren't null, in one pass."""
    return _compared(title, body)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when(both > 0, both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Share of the smaller set that the other holds; Jaccard where the smaller has fewer than eight tokens."""
    return similarity_of(F.size(F.array_intersect(a, b)), F.size(a), F.size(b))


def similarity_of(both: Column, n: Column, m: Column) -> Column:
    least = F.least(n, m)
    return F.when(both <= 0, F.lit(0.0)).when(least < fixed.CONTAINMENT_FROM, both / (n + m - both)).otherwise(both / least)


def _normal(keyword: str) -> str:
    t = unicodedata.normalize("NFKC", keyword)
    return re.sub(r"\s+", " ", re.sub(r"https?://\S+", " ", t).lower()).strip()


def slug_of(text: str) -> str:
    """slug for text that the driver has."""
    normal = _normal(text)
    s = re.sub("[^a-z0-9]+", "_", normal).strip("_")[:60]
    return s or hashlib.sha256(normal.encode()).hexdigest()[:12]


def _quoted(keyword: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", keyword)


def topic_pattern(keywords: Iterable[str]) -> str | None:
    """Keywords as one pattern: Latin ones as whole words, a plural allowed; others anywhere."""
    parts = [rf"\b{_quoted(k)}(?:e?s)?\b" if re.search("[a-z]", k) else _quoted(k) for k in map(_normal, keywords)]
    return "(?U)" + "|".join(parts) if parts else None


def rule_pattern(keywords: Iterable[str]) -> str:
    """Keywords as one pattern: Latin phrases as whole words, single Latin words by their beginning; others anywhere."""
    parts = [_quoted(k) if not re.search("[a-z]", k) else rf"\b{_quoted(k)}" + (r"\b" if " " in k.strip() else "") for k in keywords]
    return "(?U)" + "|".join(parts)


def prohibited(text: Column) -> Column:
    """Whether text names tickers or ranks."""
    found = F.lit(False)
    for p in (*fixed.TICKERS, *fixed.RANKINGS):
        found = found | F.rlike(text, F.lit("(?U)" + p))
    return found


def names_tickers(payload: Column) -> Column:
    """Whether a whole document, as JSON, holds a hint at tickers."""
    text = F.to_json(payload)
    found = F.lit(False)
    for hint in fixed.TICKER_HINTS:
        found = found | F.contains(text, F.lit(hint))
    return found


def format_value(value: Column) -> Column:
    """Thousands separated; whole numbers without decimals, others with three at most."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, F.format_number(value, 0)).otherwise(F.regexp_replace(F.format_number(value, 3), r"\.?0+$", ""))


def unfenced(text: Column) -> Column:
    """A generated answer without the fence around it."""
    return F.regexp_replace(F.regexp_replace(trim_space(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")
