"""Text expressions. All native: they stay inside generated code, apart from
the two HTML helpers that need the entity table / parser of the standard
library, and the cleaning of reviews, whose patterns Arrow walks many times as
fast as Java's matcher; these run as Arrow batches."""

from __future__ import annotations

import html
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from ..constants import (
    ABBREVIATIONS, BOILERPLATE, SHORTENED_MARK, VIETNAMESE_LETTERS, WORD, WS, WS_CHARS,
)


#: Bytes of texts that are cleaned at a time, however many a batch has.
CLEANED_BYTES = 8_000_000
#: White space without the blank.
_NOT_BLANK = WS.replace(r"\x1c-\x20", r"\x1c-\x1f")


def collapse(c: Column) -> Column:
    """White space runs to one blank, ends trimmed."""
    # A single blank stays as it is, which is most of the white space; printable ASCII fails at once.
    return F.trim(F.regexp_replace(c, f"(?![!-~])(?:[{_NOT_BLANK}][{WS}]*+| [{WS}]++)", " "))


def strip(c: Column) -> Column:
    """Unicode white space removed from both ends."""
    return F.trim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def _loose_marks_to_blanks(c: Column) -> Column:
    """``.`` and ``/`` survive only between two digits."""
    return F.regexp_replace(c, r"[./](?:(?!\p{Nd})|(?<!\p{Nd}[./]))", " ")


def _keep_letters(c: Column, ascii_kept: str) -> Column:
    """Drops all but ``ascii_kept``, Vietnamese letters and white space. Runs of
    plain characters are taken at once, without testing the long class."""
    return F.regexp_replace(c, f"(?s)([{ascii_kept}]++)|(?![{VIETNAMESE_LETTERS}{WS}]).", "$1")


#: Around a word that stands for another; no letter, so it never joins words, and no cleaned text keeps it.
_MARKS = "\ue000", "\ue001"


_LONG = {short: long for shorts, long in ABBREVIATIONS for short in shorts.split("|")}


def _where(texts: pa.Array, some: pa.Array, change: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``change`` of the texts that ``some`` marks, the others as they are."""
    return pc.replace_with_mask(texts, some, change(texts.filter(some)))


def _spelt_out(texts: pa.Array) -> pa.Array:
    """Abbreviations that are whole words, replaced: all are marked first, as no replacement holds one, and the marked
    ones are plain strings. A mark may be left where the text has some itself."""
    left, right = _MARKS

    def marked(some: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(some, f"(^|[^{WORD}])({'|'.join(_LONG)})([^{WORD}]|$)", rf"\1{left}\2{right}\3")

    def replaced(some: pa.Array) -> pa.Array:
        some = marked(some)  # again, as two neighbours share the character between them
        for short, long in _LONG.items():
            some = pc.replace_substring(some, left + short + right, long)
        return some

    texts = marked(texts)
    return _where(texts, pc.match_substring(texts, left), replaced)


def _joined_digits(texts: pa.Array) -> pa.Array:
    """Without the ``.`` and ``/`` between two digits."""
    for _ in range(2):  # two neighbours share the digit between them
        texts = pc.replace_substring_regex(texts, r"(\p{Nd})[./](\p{Nd})", r"\1\2")
    return texts


def _plain(texts: pa.Array) -> pa.Array:
    texts = _spelt_out(texts)
    texts = _where(texts, pc.match_substring_regex(texts, r"\p{Nd}[./]\p{Nd}"), _joined_digits)
    texts = pc.replace_substring_regex(texts, f"[^a-z0-9{VIETNAMESE_LETTERS}{WS}./]+", "")
    return pc.utf8_trim(pc.replace_substring_regex(texts, f"[{WS}./]{{2,}}|[{_NOT_BLANK}./]", " "), " ")


@F.pandas_udf(StringType())
def _cleaned(lowered: pd.Series) -> pd.Series:
    texts = pa.array(lowered, pa.large_string(), from_pandas=True)
    rows = max(1, len(texts) * CLEANED_BYTES // max(1, texts.nbytes))
    return pd.concat([pd.Series(dtype=object), *(_plain(texts.slice(i, rows)).to_pandas() for i in range(0, len(texts), rows))])


def clean_review_text(c: Column) -> Column:
    return _cleaned(F.lower(F.coalesce(c, F.lit(""))))


def clean_label_text(c: Column) -> Column:
    text = _loose_marks_to_blanks(F.lower(F.coalesce(c, F.lit(""))))
    return collapse(_keep_letters(text, "a-z0-9 ./"))


@F.pandas_udf(StringType())
def unescape_entities(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def clean_html_text(c: Column) -> Column:
    """Entities resolved, tags to blanks, white space collapsed; NULL to ''."""
    return collapse(F.regexp_replace(unescape_entities(F.coalesce(c, F.lit(""))), "<[^>]+>", " "))


# Elements whose content is not text of the page (fixed values).
_NO_TEXT = {"script", "style", "template", "rt", "rp"}


class _TextNodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in _NO_TEXT

    def handle_endtag(self, tag):
        self.hidden -= tag in _NO_TEXT and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


@F.pandas_udf(StringType())
def html_text_nodes(pages: pd.Series) -> pd.Series:
    def text_of(page):
        parser = _TextNodes()
        parser.feed(page)
        parser.close()
        return " ".join(parser.parts)

    return pages.map(text_of, na_action="ignore")


def html_to_text(c: Column) -> Column:
    """Text nodes of a page joined by blanks."""
    return collapse(F.coalesce(html_text_nodes(c), F.lit("")))


def strip_boilerplate(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    for phrase in BOILERPLATE:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    return collapse(text)


def compact_text(c: Column, limit: int) -> Column:
    """Trimmed; longer texts are cut at ``limit`` and marked."""
    text = strip(F.coalesce(c, F.lit("")))
    cut = F.rtrim(F.substring(text, 1, limit), F.lit(WS_CHARS))
    return F.when(F.length(text) > limit, F.concat(cut, F.lit(SHORTENED_MARK))).otherwise(text)


def words(c: Column) -> Column:
    """White space separated tokens."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"[{WS}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def terms(c: Column) -> Column:
    """Lower-case word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def contains_any(c: Column, hints: list[str]) -> Column:
    """Lower-case text contains one of the hints as a substring."""
    found = F.lit(False)
    for hint in hints:
        found = found | F.contains(F.lower(c), F.lit(hint))
    return F.coalesce(found, F.lit(False))
