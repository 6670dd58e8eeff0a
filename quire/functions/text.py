"""Text expressions: normal form, keys, block and heading recognition, table text.

Everything but ``nfkc`` is a Catalyst expression. Patterns use ``(?U)`` where white space or letters of any script count.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbering, list, code and table patterns, and word lists, that decide what a text is.
SECTION_HEADING = r"(?U)^(?:\d+(?:\.\d+){0,5}|[A-Za-z]\d+(?:\.\d+){0,5}|第[一二三四五六七八九十百千万]+[章节篇]|附录[A-Za-z0-9一二三四五六七八九十]*)[\s.:：、)）\-].+"
CHAPTER, SECTION, APPENDIX = "^第[一二三四五六七八九十百千万]+[章篇]", "^第[一二三四五六七八九十百千万]+节", "^附录"
NUMBER, LETTER_NUMBER = r"^([0-9]+(?:\.[0-9]+)*)", r"^[A-Za-z]([0-9]+(?:\.[0-9]+)*)"
LIST_ITEM = r"(?U)^\s*(?:[-*•] |\d+[.)]\s)"
CODE_KEYWORD = r"(?i)^\s*(def|class|for|if|while|return|import|from|try|except|with)\b"
CODE_MARKER = r"[:=(){}\[\].,]|->|=>"
CODE_FONTS = ["courier", "mono", "consolas", "code", "menlo", "fira", "hack", "inconsolata", "dejavu", "cascadia", "jetbrains", "lucida console"]
CODE_STATEMENT = (
    r"(?:[;{}]\s*$|^\s*[{}]\s*$|\w+\.\w+\(|\w+\([^)]*[,)]"
    r"|^\s*(?:public|private|protected|static|final|void|class|interface|def|function|const|let|var|import|from|return|try|catch|throw|new|if|else|for|while|switch|case)\b"
    r"|^\s*(?:byte|int|long|String|boolean|char|double|float)\s*[\[\]]*\s+\w|^\s*@\w+|^\s*//|/\*|\*/"
    r"|=\s*(?:new|null|true|false|\"|\d)|^\s*\*\s+@)"
)
BROKEN_WORD = r"[A-Za-z]{2,}<br>[A-Za-z]{1,}"
NESTED_SIGNAL = r"(?i)Objects of|Supported Types:|Limits?:|description\s*\("
PIPE_SEPARATOR = r"^\|\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|$"
ENDS = ".!?;:。！？；：…）)」】》"
STRUCTURE_ENDS = "。！？.!?;；:：”」』）)]"
COMMON_WORDS = [
    "a", "an", "the", "this", "that", "these", "those", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did",
    "will", "would", "shall", "should", "may", "might", "can", "could", "not", "no", "or", "and", "but", "if", "of", "at", "by", "for", "in", "on", "to",
    "with", "from", "as", "all", "each", "every", "any", "some", "its", "per",
]
ILLEGAL_IN_NAMES = '<>:"/\\|?*'


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode normal form KC; no built-in function has it."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def squeeze(text: Column) -> Column:
    """White space of any script to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def normalized(text: Column) -> Column:
    return squeeze(nfkc(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def text_hash(norm: Column) -> Column:
    return F.sha2(norm, 256)


def bbox_hash(bbox: Column) -> Column:
    """Of a box that is already rounded; null or none gives an empty hash."""
    return F.when(F.coalesce(F.size(bbox), F.lit(0)) > 0, F.substring(F.sha1(F.to_json(bbox)), 1, 10)).otherwise("")


def dedupe_key(page: Column, norm: Column, box: Column | None = None) -> Column:
    return F.concat_ws(":", page.cast("string"), F.substring(F.sha1(norm), 1, 12), F.lit("") if box is None else box)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def round_box(boxes: pd.Series) -> pd.Series:
    """Three decimals of the exact binary value."""
    return boxes.map(lambda b: None if b is None else [round(float(x), 3) for x in b])


def words(text: Column) -> Column:
    return F.filter(F.split(squeeze(text), " "), lambda w: w != "")


def number_depth(text: Column) -> Column:
    """Dots of a leading section number, plus one, 6 at most; null without a number."""
    s = strip(text)
    number = F.coalesce(F.nullif(F.regexp_extract(s, NUMBER, 1), F.lit("")), F.nullif(F.regexp_extract(s, LETTER_NUMBER, 1), F.lit("")))
    return F.when(number.isNotNull(), F.least(F.length(number) - F.length(F.replace(number, F.lit("."))) + 1, F.lit(6)))


def level_of_numbering(text: Column) -> Column:
    s = strip(text)
    return F.when(s.rlike(CHAPTER) | s.rlike(APPENDIX), 1).when(s.rlike(SECTION), 2).otherwise(number_depth(text))


def heading_level(text: Column, size: Column | None = None, largest: Column | None = None) -> Column:
    """1 to 6 from the numbering, else from the font's share of the page's largest, else 2."""
    level = level_of_numbering(text)
    if size is not None and largest is not None:
        share = F.when((size > 0) & (largest > 0), size / largest)
        level = F.coalesce(level, F.when(share >= 0.95, 1).when(share >= 0.8, 2).when(share >= 0.65, 3))
    return F.coalesce(level, F.lit(2))


def looks_like_heading(text: Column, size: Column, largest: Column) -> Column:
    fits = (largest > 0) & (size >= 14) & (size >= largest * 0.85) & (F.length(text) <= 120)
    return F.coalesce(fits & strip(text).rlike(SECTION_HEADING), F.lit(False))


def is_list_item(text: Column) -> Column:
    return text.rlike(LIST_ITEM)


def is_code_block(text: Column, fonts: Column) -> Column:
    """By a monospaced font, indentation, keywords with markers, or the density of markers."""
    by_font = F.exists(fonts, lambda f: F.lower(f).rlike("|".join(CODE_FONTS)))
    lines = F.filter(F.split(text, "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: strip(x) != "")
    n = F.size(lines)
    count = lambda test: F.size(F.filter(lines, test))
    indented, keywords, markers = count(lambda x: x.rlike("^(    |\t)")), count(lambda x: x.rlike(CODE_KEYWORD)), count(lambda x: x.rlike(CODE_MARKER))
    by_text = (n >= 2) & ((indented >= F.greatest(F.lit(2.0), n * 0.6)) | ((keywords > 0) & (markers > 0)) | ((n >= 3) & (markers >= n * 0.7)))
    return F.coalesce(by_font, F.lit(False)) | F.coalesce(by_text, F.lit(False))


def is_code_like(text: Column) -> Column:
    s = strip(text)
    return (F.length(s) > 0) & (F.length(s) <= 200) & s.rlike("[a-zA-Z]") & s.rlike(CODE_STATEMENT)


def ends_sentence(text: Column, ends: str = ENDS) -> Column:
    return F.instr(F.lit(ends), F.right(text, F.lit(1))) > 0


def goes_on(text: Column) -> Column:
    """Whether a text starts as the middle of a sentence: lower case or a comma."""
    return F.coalesce(text.rlike(r"^\p{Ll}") | text.rlike("^[，、]"), F.lit(False))


def rejoin(text: Column) -> Column:
    """Two words that are one identifier, cut by a line end."""
    parts = words(text)
    left, right = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    joined = F.concat(left, right)
    camel = joined.rlike("[a-z][A-Z]")
    small, large = right.rlike(r"^\p{Ll}"), right.rlike(r"^\p{Lu}")
    fits = (F.size(parts) == 2) & (F.length(joined) <= 35) & camel & (small | (large & (left == F.lower(left)) & ~left.isin(*COMMON_WORDS)))
    return F.when(F.coalesce(fits, F.lit(False)), joined).otherwise(text)


def pipe_cell(value: Column) -> Column:
    text = rejoin(F.coalesce(value, F.lit("")))
    text = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.trim(F.replace(F.replace(text, F.lit("\r\n"), F.lit("<br>")), F.lit("\n"), F.lit("<br>")))


def pipe_table(headers: Column, rows: Column) -> Column:
    """A pipe table with as many cells a row as there are headers; empty without headers."""
    row = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    n = F.size(headers)
    rule = row(F.array_repeat(F.lit("---"), n))
    filled = F.transform(F.coalesce(rows, F.array().cast("array<array<string>>")), lambda r: row(F.transform(headers, lambda _, i: F.coalesce(pipe_cell(F.get(r, i)), F.lit("")))))
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.array_join(F.concat(F.array(row(F.transform(headers, pipe_cell)), rule), filled), "\n")).otherwise("")


def is_corrupted_table(markdown: Column) -> Column:
    """Fragments of words in a pipe table."""
    cells = lambda line: F.filter(F.transform(F.split(line, r"\|"), strip), lambda c: c.rlike(r"^\p{L}.?$"))
    lines = F.filter(F.split(markdown, "\n"), lambda x: F.ltrim(x).startswith("|"))
    return markdown.rlike(BROKEN_WORD) | F.exists(lines, lambda x: F.size(cells(x)) >= 2)


def repaired_table(markdown: Column) -> Column:
    """A pipe table with identifiers rejoined; separator rows and other lines as they are."""

    def fix(line: Column) -> Column:
        s = strip(line)
        cells = F.transform(F.split(s, r"\|"), lambda c: rejoin(strip(c)))
        inner = F.slice(cells, 2, F.greatest(F.size(cells) - 2, F.lit(0)))
        whole = F.concat(F.lit("| "), F.array_join(inner, " | "), F.lit(" |"))
        return F.when(s.startswith("|") & s.endswith("|") & (F.length(s) > 1) & ~s.rlike(PIPE_SEPARATOR), whole).otherwise(line)

    return F.array_join(F.transform(F.split(strip(markdown), "\n"), fix), "\n")


def with_separator(markdown: Column) -> Column:
    """A pipe table whose second line is no separator gets one."""
    lines = F.split(strip(markdown), "\n")
    bars = F.length(lines[0]) - F.length(F.replace(lines[0], F.lit("|")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.greatest(bars - 1, F.lit(1))), " | "), F.lit(" |"))
    lacks = (F.size(lines) >= 2) & (bars > 0) & ~strip(F.get(lines, F.lit(1))).rlike(PIPE_SEPARATOR) & ~strip(markdown).startswith("<")
    return F.when(lacks, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")).otherwise(markdown)


def fences(markdown: Column) -> Column:
    return F.size(F.filter(F.split(markdown, "\n"), lambda x: strip(x).startswith("```")))


def escape_html(clean: Column) -> Column:
    """Of a cell text that is already clean."""
    out = F.replace(F.replace(F.replace(clean, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.replace(F.replace(out, F.lit("\r\n"), F.lit("<br/>")), F.lit("\n"), F.lit("<br/>"))


def escape_attribute(clean: Column) -> Column:
    return F.replace(escape_html(clean), F.lit('"'), F.lit("&quot;"))


def safe_name(title: Column, empty: str = "", dots: bool = True) -> Column:
    """A title as a file name: illegal characters become underscores, dots and spaces at the ends go."""
    out = F.translate(title, ILLEGAL_IN_NAMES, "_" * len(ILLEGAL_IN_NAMES))
    out = F.btrim(out, F.lit(". ")) if dots else F.trim(out)
    return F.when(out == "", F.lit(empty)).otherwise(out)


def fitted_name(name: Column, longest: Column | int) -> Column:
    """A name cut to a length, with a mark, keeping its suffix."""
    most = F.lit(longest) if isinstance(longest, int) else longest
    suffix = F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)
    stem = F.left(name, F.length(name) - F.length(suffix))
    kept = F.regexp_replace(F.left(stem, F.greatest(most - F.length(suffix) - 2, F.lit(1))), "[ .]+$", "")
    return F.when(F.length(name) <= most, name).otherwise(F.concat(F.when(kept == "", "item").otherwise(kept), F.lit("__"), suffix))


def block_markdown(kind: Column, text: Column, level: Column) -> Column:
    good = F.when(level.between(1, 6), level).otherwise(2)
    body = F.when(kind == "heading", F.concat(F.repeat(F.lit("#"), good), F.lit(" "), text)).when(kind == "list_item", F.concat(F.lit("- "), text)).when(kind == "code", F.concat(F.lit("```\n"), text, F.lit("\n```")))
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(body.otherwise(text))
